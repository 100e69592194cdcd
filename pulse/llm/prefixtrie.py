"""The prefix trie of conversations: what their common beginnings would save.

A conversation is a path of turns; each distinct beginning of a path is a node. A turn is reduced to
a 128-bit digest and its length, and a node's name is the chained hash of the digests from the root, so
the names of a path's nodes, one after the other, are a binary key whose order is that of a walk through
the trie. Paths are sorted by that key and dealt by range into shards. A shard is a run of the sorted
rows of bounded size, however the ranges turn out.

A shard holds its part of the trie as balanced parentheses: one opens where a path leaves its
predecessor, one closes where it is left. The excess of open ones is kept with its least
value in each block and a tree over the blocks; ``findclose`` walks to the first place where the
excess falls below a node's own, and so delimits its subtree. Within these bounds, ranks of the
pairs ``()`` count leaves, and differences of cumulative arrays give members and savings.

Only nodes on a shard's first and last path can go on in another shard. Their shares (members, smallest
member, children, leaves and savings that hang beside these spines) travel with the two paths, which are
again sorted paths: the same step merges them, each time some thousand shards in one, until one is left.
Its rows give the shards the smallest member of each spine node, which is their rows' parent.

A digest over all conversations that end at a node is made in the shard, where they stand
side by side in order. Those of spine nodes leave it in short pieces, which are then hashed as a sorted
stream: SHA-256 is sequential, so the conversations of one node, all alike, pass one task, piece by piece.

Defined cases: turns are ordered by turn number (null first), equal numbers by role and text; null role
or text is empty; repeated rows are turns of their own; rows without a conversation id belong to no
conversation and are left out; a conversation id is an integer; an empty text saves nothing but is a turn;
an empty table gives an empty result, else there is a root. Texts are reduced to digests by Spark's own functions and never sent to
Python, so their length does not matter. A conversation's path (20 bytes a turn) has to fit in a row.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.shared import written

NAME = 16
#: Turns of a shard, and the fewest paths it has even if they are longer: two of them go on.
SHARD_TURNS, SHARD_PATHS = 1 << 18, 16
#: Places of one block of excess values.
BLOCK = 64
#: Conversation ids of one piece of a spine node's digest.
PIECE_IDS = 256
NOBODY = np.iinfo(np.int64).max
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
#: A path's shares, one for each of its nodes from the root.
SHARES = ("convs", "least", "kids", "leaves", "saved")

FINAL, PENDING, SPINE, PIECE = range(4)
PATHS = "path binary, lengths binary, shares binary, conv long"
ROWS = ("kind int, shard long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, name binary, parent binary, path binary, lengths binary, shares binary, ids string")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_turns(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv, at, digest, length``: turns numbered from 0 in their conversation, texts reduced to digest and length."""
    given = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("__turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{name}") for name, c in (("role", role), ("text", text))),
    )
    said = F.concat(F.char_length("__role").cast("string"), F.lit(":"), F.col("__role"), F.col("__text"))
    order = Window.partitionBy("conv").orderBy(F.col("__turn").asc_nulls_first(), "__role", "__text")
    numbered = given.select("*", F.unhex(F.md5(said.cast("binary"))).alias("digest"),
                            F.char_length("__text").alias("length"), F.row_number().over(order).alias("at"))
    return numbered.select("conv", (F.col("at") - 1).alias("at"), "digest", "length")


def paths_of(turns: DataFrame) -> DataFrame:
    """One row per conversation from ``conv, at, digest, length`` rows; a null digest only says that there is one."""

    def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, names, lengths, name, done = None, [], [], b"", []

        def made() -> pa.RecordBatch:
            columns = (*zip(*done), [None] * len(done)) if done else ([], [], [], [])
            path, length, of, shares = columns
            arrays = [pa.array(path, pa.binary()), pa.array(length, pa.binary()), pa.array(shares, pa.binary()), pa.array(of, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["path", "lengths", "shares", "conv"])

        for batch in batches:
            for of, digest, length in zip(*(column.to_pylist() for column in batch.columns)):
                if of != conv:
                    if conv is not None:
                        done.append((b"".join(names), np.array(lengths, "<i4").tobytes(), conv))
                    conv, names, lengths, name = of, [], [], b""
                if digest is not None:
                    name = xxhash.xxh3_128_digest(name + digest)
                    names.append(name), lengths.append(length)
            yield made()
            done = []
        if conv is not None:
            done.append((b"".join(names), np.array(lengths, "<i4").tobytes(), conv))
            yield made()

    sorted_turns = turns.repartition("conv").sortWithinPartitions("conv", "at").select("conv", "digest", "length")
    return sorted_turns.mapInArrow(chained, PATHS)


class Parentheses:
    """A balanced sequence of +1 and -1 with the least excess of each block, of each pair of blocks, and so on."""

    def __init__(self, signs: np.ndarray, block: int = BLOCK) -> None:
        self.signs, self.block, self.excess = signs, block, np.cumsum(signs, dtype=np.int64)
        blocks = 1 << (max(1, -(-len(signs) // block)) - 1).bit_length()
        self._padded = np.full(blocks * block, NOBODY)
        self._padded[: len(signs)] = self.excess
        self.least = [self._padded.reshape(blocks, block).min(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))

    def findclose(self, opened: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at these places close: the first later place with an excess below their own."""
        target, found = self.excess[opened] - 1, np.full(len(opened), -1)
        self._scan_block(found, np.arange(len(opened)), opened + 1, target)
        far = np.flatnonzero(found < 0)
        node, level = (opened[far] + 1) // self.block, np.zeros(len(far), np.int64)
        climbing = np.arange(len(far))
        for up, least in enumerate(self.least):  # until the neighbour to the right holds the place
            at = node[climbing]
            beside = at % 2 == 0
            beside[beside] = least[at[beside] + 1] <= target[far[climbing[beside]]] if len(least) > 1 else False
            node[climbing] = np.where(beside, at + 1, at // 2)
            level[climbing[beside]] = up
            climbing = climbing[~beside]
            if not len(climbing):
                break
        for down in range(len(self.least) - 1, 0, -1):  # and down to the first block that does
            which = np.flatnonzero(level == down)
            left = node[which] * 2
            node[which] = np.where(self.least[down - 1][left] <= target[far[which]], left, left + 1)
            level[which] = down - 1
        self._scan_block(found, far, node * self.block, target)
        return found

    def _scan_block(self, found: np.ndarray, which: np.ndarray, start: np.ndarray, target: np.ndarray) -> None:
        """From each start to the end of its block."""
        at, end = start, np.minimum((start // self.block + 1) * self.block, len(self.signs))
        while len(which):
            inside = at < end
            which, at, end = which[inside], at[inside], end[inside]
            hit = self._padded[at] <= target[which]
            found[which[hit]] = at[hit]
            which, at, end = which[~hit], at[~hit] + 1, end[~hit]

    def leaf_pairs(self) -> np.ndarray:
        """At which places a parenthesis closes at once."""
        return (self.signs == 1) & (np.append(self.signs[1:], 1) == -1)


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums over each node's subtree: nodes stand in the order of their opening, a subtree's in one run."""
    cumulative = np.concatenate([[0], np.cumsum(values)])
    at = np.arange(len(size))
    return cumulative[at + size] - cumulative[at]


class Shard:
    """The trie of one run of sorted paths; node 0 is the root."""

    def __init__(self, paths: list[bytes], lengths: list[bytes], shares: list[bytes | None], convs: list[int | None]) -> None:
        self.convs_of, self._paths, self._lengths = convs, paths, lengths
        names = np.frombuffer(b"".join(paths), "<u8").reshape(-1, 2)
        turns = np.array([len(p) // NAME for p in paths], np.int64)
        self._start = start = np.concatenate([[0], np.cumsum(turns)])
        of = np.repeat(np.arange(len(paths)), turns)
        depth = np.arange(len(names)) - start[of] + 1
        again = np.zeros(len(names), bool)
        later = np.flatnonzero((of > 0) & (depth <= turns[of - 1]))
        again[later] = (names[later] == names[start[of[later] - 1] + depth[later] - 1]).all(axis=1)
        common = np.bincount(of[again], minlength=len(paths))

        closing = np.concatenate([[0], turns[:-1] - common[1:]])
        moves = np.concatenate([[0, 1], np.stack([closing, turns - common], axis=1).ravel(), [turns[-1] + 1]])
        signs = np.repeat(np.tile([-1, 1], len(moves) // 2 + 1)[: len(moves)], moves)
        self.parentheses = Parentheses(signs)
        opened = np.flatnonzero(signs == 1)
        self.closed = self.parentheses.findclose(opened)
        self.size = (self.closed - opened + 1) // 2

        self._turn = np.flatnonzero(~again)  # of each node but the root
        self.depth = np.concatenate([[0], depth[self._turn]])
        # The node of a turn that stands in an earlier path is the one opened last at its depth.
        order = np.argsort(depth, kind="stable")
        opener = np.maximum.accumulate(np.where(again[order], 0, np.arange(len(order))))
        self._node = np.empty(len(names), np.int64)
        self._node[order] = np.cumsum(~again)[order][opener]
        before = np.concatenate([self._node[self._turn - 1], []]).astype(np.int64)
        self.parent = np.concatenate([[0], np.where(self.depth[1:] == 1, 0, before)])
        self.length = np.concatenate([[0], np.frombuffer(b"".join(lengths), "<i4")[self._turn].astype(np.int64)])

        self._take_shares(shares, convs, turns)
        self.convs = _sums(self._own["convs"], self.size)
        pairs = self.parentheses.leaf_pairs()
        pairs[opened[self._own["kids"] > 0]] = False
        rank = np.cumsum(pairs)
        self.is_leaf = pairs[opened]
        self.leaves = rank[self.closed] - rank[opened] + self.is_leaf + _sums(self._own["leaves"], self.size)
        self.saving = (self.convs - 1) * self.length
        self.saved = _sums(self.saving + self._own["saved"], self.size)
        self.kids = np.bincount(self.parent[1:], minlength=len(self.parent)) + self._own["kids"]
        self.least = self._own["least"].copy()
        by_depth = np.argsort(self.depth, kind="stable")
        bounds = np.searchsorted(self.depth[by_depth], np.arange(1, self.depth.max() + 2))
        for low, high in zip(bounds[-2::-1], bounds[:0:-1]):
            nodes = by_depth[low:high]
            np.minimum.at(self.least, self.parent[nodes], self.least[nodes])

    def _take_shares(self, shares: list[bytes | None], convs: list[int | None], turns: np.ndarray) -> None:
        nodes = len(self.depth)
        self._own = {s: np.full(nodes, NOBODY) if s == "least" else np.zeros(nodes, np.int64) for s in SHARES}
        last = np.maximum(self._start[1:] - 1, 0)
        self.end = np.where(turns > 0, self._node[last] if len(self._node) else 0, 0)
        if shares[0] is None:
            np.add.at(self._own["convs"], self.end, 1)
            np.minimum.at(self._own["least"], self.end, np.array(convs, np.int64))
            return
        at = np.concatenate([x for i in range(len(turns)) for x in ([0], self.on_path(i))]).astype(np.int64)
        values = np.frombuffer(b"".join(shares), "<i8").reshape(-1, len(SHARES))
        for column, share in enumerate(SHARES):
            (np.minimum if share == "least" else np.add).at(self._own[share], at, values[:, column])

    def on_path(self, path: int) -> np.ndarray:
        """The nodes of a path but the root."""
        return self._node[self._start[path] : self._start[path + 1]]

    def name(self, node: int) -> bytes:
        if node == 0:
            return b""
        turn = int(self._turn[node - 1])
        path = int(np.searchsorted(self._start, turn, "right")) - 1
        at = (turn - int(self._start[path])) * NAME
        return self._paths[path][at : at + NAME]

    def spine(self) -> np.ndarray:
        """Which nodes may go on in a neighbouring shard."""
        found = np.zeros(len(self.depth), bool)
        found[0] = True
        found[self.on_path(0)] = found[self.on_path(len(self._paths) - 1)] = True
        return found

    def spine_paths(self, spine: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
        """First and last path with what hangs beside them; a node of both has its shares on the first."""
        shares = np.zeros((len(self.depth), len(SHARES)), np.int64)
        shares[:, 0], shares[:, 2] = self.convs, self.kids
        shares[:, 3], shares[:, 4] = self.leaves - self.is_leaf, self.saved - self.saving
        shares[:, 1] = self._own["least"]
        inner = np.flatnonzero(spine)[1:]
        for column, whole in ((0, self.convs), (2, np.ones_like(self.kids)), (3, self.leaves), (4, self.saved)):
            np.subtract.at(shares[:, column], self.parent[inner], whole[inner])
        beside = np.flatnonzero(~spine)
        np.minimum.at(shares[:, 1], self.parent[beside], self.least[beside])
        nothing = np.array([0, NOBODY, 0, 0, 0])
        first = np.concatenate([[0], self.on_path(0)])
        found = [(self._paths[0], self._lengths[0], shares[first].astype("<i8").tobytes())]
        if len(self._paths) > 1:
            last = np.concatenate([[0], self.on_path(len(self._paths) - 1)])
            rest = np.where(np.isin(last, first)[:, None], nothing, shares[last])
            found.append((self._paths[-1], self._lengths[-1], rest.astype("<i8").tobytes()))
        return found

    def ends(self) -> Iterator[tuple[int, list[int]]]:
        """Each node where conversations end, with their ids in order."""
        bounds = np.flatnonzero(np.diff(self.end)) + 1
        for low, high in zip([0, *bounds], [*bounds, len(self.end)]):
            yield int(self.end[low]), self.convs_of[low:high]

    def rows(self, number: int, level: int, whole: bool) -> Iterator[pa.RecordBatch]:
        spine = np.zeros(len(self.depth), bool) if whole else self.spine()
        digests = np.full(len(self.depth), EMPTY_DIGEST, object)
        pieces = []
        if level == 0:
            for node, ids in self.ends():
                if spine[node]:
                    parts = [ids[i : i + PIECE_IDS] for i in range(0, len(ids), PIECE_IDS)]
                    pieces += [(self.name(node), part[0], ",".join(map(str, part))) for part in parts]
                else:
                    digests[node] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out = np.flatnonzero(~spine)
        root = out == 0
        pending = spine[self.parent[out]] & ~root
        columns = {
            "kind": np.where(pending, PENDING, FINAL).astype("i4"), "conv_id": self.least[out], "depth": self.depth[out],
            "parent_conv_id": pa.array(self.least[self.parent[out]], mask=pending | root), "n_convs": self.convs[out],
            "n_children": self.kids[out], "n_leaves": self.leaves[out], "saved_tokens": self.saved[out],
            "ends_sha256": pa.array(digests[out], pa.string()),
        }
        if level:
            columns["name"] = pa.array([self.name(int(k)) for k in out], pa.binary())
        columns["parent"] = pa.array([self.name(int(self.parent[k])) if w else None for k, w in zip(out, pending)], pa.binary())
        yield _batch(number, len(out), columns)
        if not whole:
            path, lengths, shares = (pa.array(c, pa.binary()) for c in zip(*self.spine_paths(spine)))
            yield _batch(number, len(path), {"kind": np.full(len(path), SPINE, "i4"), "path": path, "lengths": lengths, "shares": shares})
        if pieces:
            names, first, ids = zip(*pieces)
            yield _batch(number, len(pieces), {"kind": np.full(len(pieces), PIECE, "i4"), "name": pa.array(names, pa.binary()),
                                               "conv_id": pa.array(first, pa.int64()), "ids": pa.array(ids, pa.string())})


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_ROW_TYPES = {name: _ARROW[kind] for name, kind in (field.split() for field in ROWS.split(", "))}


def _batch(shard: int, rows: int, columns: dict[str, object]) -> pa.RecordBatch:
    columns["shard"] = np.full(rows, shard, np.int64)
    made = [pa.array(columns[n], t) if n in columns else pa.nulls(rows, t) for n, t in _ROW_TYPES.items()]
    return pa.RecordBatch.from_arrays(made, list(_ROW_TYPES))


def _shards(paths: DataFrame, level: int, shards: int | None, shard_turns: int, shard_paths: int) -> DataFrame:
    """Rows of all shards; with one shard everything is in it."""
    whole = shards == 1

    def built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, turns = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(row)
                turns += len(row[0]) // NAME
                if turns >= shard_turns and len(held) >= shard_paths and not whole:
                    yield from Shard(*map(list, zip(*held))).rows(number, level, whole)
                    number, held, turns = number + 1, [], 0
        if held:
            yield from Shard(*map(list, zip(*held))).rows(number, level, whole)

    if whole:
        dealt = paths.repartition(1)
    else:
        dealt = paths.repartitionByRange(*([shards] if shards else []), "path", "conv")
    rows = dealt.sortWithinPartitions("path", "conv").select("path", "lengths", "shares", "conv").mapInArrow(built, ROWS)
    return written(rows, f"trie-{level}")


def _piece_digests(pieces: DataFrame) -> DataFrame:
    """``name, digest`` of each node's pieces, hashed in order as they come."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([running.hexdigest()])], ["name", "digest"])

        for batch in batches:
            for of, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if of != name:
                    if name is not None:
                        yield row()
                    name, running = of, hashlib.sha256(ids.encode())
                else:
                    running.update(f",{ids}".encode())
        if name is not None:
            yield row()

    ordered = pieces.repartition("name").sortWithinPartitions("name", "conv_id").select("name", "ids")
    return ordered.mapInArrow(hashed, "name binary, digest string")


def trie_nodes(turns: DataFrame, shard_turns: int = SHARD_TURNS, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """All nodes of the trie of ``conv, at, digest, length`` rows."""
    if shard_paths < 4:
        raise ValueError("a shard hands on two paths, so it needs four at least to leave fewer")
    paths = written(paths_of(turns), "paths")
    levels, shards = [], None
    while True:
        rows = _shards(paths, len(levels), shards, shard_turns, shard_paths)
        levels.append(rows)
        if shards == 1:
            break
        paths = rows.filter(F.col("kind") == SPINE).select("path", "lengths", "shares", "conv_id").withColumnRenamed("conv_id", "conv")
        size = paths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("bytes")).first()
        # Each shard hands on two paths at most, so with this many there are far fewer next time.
        shards = max(1, min(size["bytes"] // NAME // shard_turns, size["n"] // shard_paths))

    merged = [rows.filter(F.col("kind") < SPINE) for rows in levels]
    resolved = None
    for rows in merged[1:]:
        known = rows.select("name", F.col("conv_id").alias("found"))
        resolved = known if resolved is None else resolved.unionByName(known)
    results = []
    for level, (rows, own) in enumerate(zip(levels, merged)):
        nodes = own.filter(F.col("kind") == FINAL)
        if level < len(levels) - 1:
            steps = F.explode(F.sequence(F.lit(0), (F.octet_length("path") / NAME).cast("int"))).alias("d")
            on_spine = rows.filter(F.col("kind") == SPINE).select("shard", "path", steps).select(
                "shard", F.expr(f"IF(d = 0, X'', substring(path, {NAME} * (d - 1) + 1, {NAME}))").alias("name")).distinct()
            parents = on_spine.join(resolved, "name").select("shard", F.col("name").alias("parent"), "found")
            waiting = own.filter(F.col("kind") == PENDING).join(parents, ["shard", "parent"])
            nodes = nodes.unionByName(waiting.withColumn("parent_conv_id", F.col("found")).select(*nodes.columns))
        if level:
            digests = _piece_digests(levels[0].filter(F.col("kind") == PIECE))
            nodes = nodes.join(digests, "name", "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(EMPTY_DIGEST)))
        results.append(nodes.select(*RESULT))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found
