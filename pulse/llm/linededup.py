"""Line deduplication by an exact set-similarity join.

A line is the set of its 5-word shingles (a line of fewer words is one shingle). A line is
removed if an earlier line, by key, text and line number, has the same set or a Jaccard similarity of at
least ``threshold``. Lines without words stay.

Equal sets are found by grouping on 128 bits, two independent hashes of the words. For the rest, the tokens of a line are ordered by rarity over
all lines (counts from a sketch that every shingle enters, ties by hash). Two lines of
the needed similarity share a token among the first ``n - ceil(threshold * n) + 1`` of each, so
only these prefixes are dealt out by token. What meets there passes the length bound and the
positional bound (what the two orders can still have in common after the token) and the bound of 64 parity bits,
one of which each token of a line flips (lines differ in as many tokens as bits at least), and is
then verified on the whole lines. Tokens that only one line has, and lines that the bounds leave no other of
a token with at most ``SMALL_GROUP`` lines, are dropped on arrival.

The lines of a token are ranked by position. Each is compared with the first one, those
that matched nothing with the next fifteen, and those that still have no match with all earlier
lines of all their tokens, so no pair is lost and a group of similar lines costs
about one comparison for each.

Texts of lines to be verified, and documents that lose lines, are found by a join on the key; a
fixed-size membership filter keeps most other documents out of the shuffle and drops none.

Defined cases: the key is an integer, a null key counts as the last one; rows with equal key and
text (``body``, its 64-bit hash, or 0 where only one row has the key) are copies of one document: a line's first occurrence stays in each;
rows with equal key and different texts are different documents, ordered by that hash; a null text stays null
and has no lines; a document that loses every line has an empty text (or goes, see
``drop_repeated_lines``); an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.membership import LAST_KEY, contained, hash_keys, key_numbers, maybe_member, members
from pulse.llm.shared import numbered, workspace, written
from pulse.llm.shingles import Held, Sketch, added_up, chunks, distinct, distinct_tokens, mix, shingles, shingles_by, text_buffer

THRESHOLD = 0.8
#: Prefix entries that a task holds before it deals them out.
HELD_ENTRIES = 1 << 19
#: Shingles of the corpus for each bucket of the prefix join: about a quarter of them arrive, some 20 MB.
BUCKET_SHINGLES = 2_000_000
#: A token of more lines than this is dealt out by its lines as well, so that no bucket has to hold them all.
HOT_TOKEN = 100_000
#: Lines of a token that are tried after the first one and before all the others.
NEXT_RANKS = 16
#: Lines that are packed with their tokens at once.
MOST_LINES = 1 << 20
#: The place of a line, in the order of lines.
PLACE = ["key", "body", "line"]
BY_PLACE = [f"by_{c}" for c in PLACE]


# ---- lines of a batch --------------------------------------------------------------------------


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(offsets of lines, document row, line number)``; a line ends after its newline or with its text."""
    cuts = np.union1d(np.flatnonzero(data == 10) + 1, offsets)
    starts = cuts[:-1]
    row = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(starts, offsets[row])
    return cuts, row, np.arange(len(starts)) - first


def line_runs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of at most ``MOST_LINES`` lines: row and number of each, the bytes and the offsets of the lines."""
    data, offsets = text_buffer(column)
    for start, stop in chunks(offsets):
        own, bounds = data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        if len(own):
            cuts, row, number = line_offsets(own, bounds)
            for i in range(0, len(row), MOST_LINES):
                part = cuts[i : i + MOST_LINES + 1]
                yield row[i : i + MOST_LINES] + start, number[i : i + MOST_LINES], own[part[0] : part[-1]], part - part[0]


def line_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of documents: row and number of each line, and ``(line, hash)`` of the distinct shingles."""
    for row, number, own, cuts in line_runs(column):
        yield row, number, *distinct_tokens(*shingles(own, cuts))


def line_names(own: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(line, name1, name2)`` of each line that has words, and all distinct shingles; the names are the identity of its set.

    They come from two independent hashes of the words, 64 bits each.
    """
    line, (value, second) = shingles_by(own, cuts, (0, 1))
    short = (line.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
    short.sort()
    doubtful = np.unique(short[1:][short[1:] == short[:-1]] >> np.uint64(44)).astype(np.int64)
    if len(doubtful):  # only lines that say something twice are sorted by whole values
        among = np.zeros(len(cuts) - 1, bool)
        among[doubtful] = True
        at = np.flatnonzero(among[line])
        at = at[np.lexsort((value[at], line[at]))]
        new = np.ones(len(line), bool)
        new[at[1:]] = (line[at[1:]] != line[at[:-1]]) | (value[at[1:]] != value[at[:-1]])
        line, value, second = line[new], value[new], second[new]
    if not len(line):
        return line, value, second, value
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    return line[starts], mix(np.add.reduceat(value, starts)), mix(np.add.reduceat(second, starts)), value


def set_names(line: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(line, size, name)`` of each line that has tokens; the name tells the sets that share a token apart."""
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(line)))
    return line[starts], sizes, mix(np.add.reduceat(value, starts) if len(starts) else value)


def occurrences(docs: DataFrame) -> tuple[DataFrame, Sketch]:
    """``name1, name2, key, body, line, again`` of every line with words, and the counts of all their tokens.

    ``again`` says that the document had the set before. Both come from one pass: a task ends
    with the slices of its counts.
    """
    columns = ["name1", "name2", "key", "body", "line", "again"]

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, held = Sketch(), Held()
        for batch in batches:
            keys, bodies = key_numbers(batch.column(0)), key_numbers(batch.column(2))
            for row, number, own, cuts in line_runs(batch.column(1)):
                at, one, two, value = line_names(own, cuts)
                held.add(value, sketch)
                order = np.lexsort((at, one, row[at]))
                again = np.zeros(len(at), bool)
                a, b = order[1:], order[:-1]
                again[a] = (row[at[a]] == row[at[b]]) & (one[a] == one[b]) & (two[a] == two[b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(keys[row[at]]), pa.array(bodies[row[at]]),
                     pa.array(number[at].astype(np.int32)), pa.array(again),
                     pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())], [*columns, "slice", "cells"])
        held.flush(sketch)
        for part in sketch.slices():
            empty = [pa.nulls(len(part), t) for t in (*[pa.int64()] * 4, pa.int32(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*empty, *part.columns], [*columns, "slice", "cells"])

    both = written(docs.mapInArrow(
        named, "name1 long, name2 long, key long, body long, line int, again boolean, slice int, cells binary"), "occurrences")
    sketch = added_up(both.filter(F.col("slice").isNotNull()).select("slice", "cells"))
    return both.filter(F.col("slice").isNull()).select(*columns), sketch


# ---- prefix join -------------------------------------------------------------------------------


def needed(n: np.ndarray, threshold: float) -> np.ndarray:
    return np.ceil(n * threshold - 1e-9).astype(np.int64)


_ENTRY = np.dtype([("token", "<u8"), ("name", "<u8"), ("key", "<i8"), ("body", "<i8"), ("line", "<i4"), ("n", "<i4"), ("place", "<i4"),
                   ("mark", "<u8")])
#: What travels besides the key.
FIELDS = ("body", "line", "n", "place", "token", "name", "mark")
#: The bits of tokens and names that travel. Tokens that agree in them meet, which the comparison of whole lines sets right.
SENT = np.uint64(0xFFFFFFFFFF000000)
#: Bytes of a field that are left out, the lowest ones.
UNSENT = {"token": 3, "name": 3}
#: Lines of a token that are all compared by their bounds on arrival.
SMALL_GROUP = 64


def prefix_entries(row, number, line, value, keys, bodies, sketch: Sketch, threshold: float, copied: np.ndarray | None) -> np.ndarray:
    """An ``_ENTRY`` for each token in the prefix of each line. The last bit of its name says whether it has to travel."""
    # Counts by powers of two above their noise; equal classes keep the order of the hashes. The keys are nearly sorted.
    common = np.log2(1 + sketch.counts(value) / (8 * (sketch.noise() + 1))).astype(np.int64)
    order = np.argsort(line * 64 + common, kind="stable")
    line, value = line[order], value[order]
    at, sizes, name = set_names(line, value)
    places = hash_keys(keys[row[at]], bodies[row[at]], number[at])
    name = (name & SENT) + (np.uint64(1) if copied is None else contained(copied, places).astype(np.uint64))
    mark = parity_marks(line, value)
    place = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < np.repeat(sizes - needed(sizes, threshold) + 1, sizes)
    entries = np.empty(int(inside.sum()), _ENTRY)
    for field, values in (("token", value & SENT), ("name", np.repeat(name, sizes)), ("key", np.repeat(keys[row[at]], sizes)),
                          ("body", np.repeat(bodies[row[at]], sizes)),
                          ("line", np.repeat(number[at], sizes)), ("n", np.repeat(sizes, sizes)), ("place", place), ("mark", np.repeat(mark, sizes))):
        entries[field] = values[inside]
    return entries


def parity_marks(line: np.ndarray, value: np.ndarray) -> np.ndarray:
    """64 bits for each line that has tokens, each token flipping one: sets differ in as many tokens as marks in bits at least."""
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    flips = np.uint64(1) << (value >> np.uint64(58))
    return np.bitwise_xor.reduceat(flips, starts) if len(starts) else flips


def repeated(values: np.ndarray) -> np.ndarray:
    """Whether a value is there more than once."""
    order = np.argsort(values)
    same = values[order[1:]] == values[order[:-1]]
    found = np.zeros(len(values), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    return found


def identity(entries: np.ndarray) -> np.ndarray:
    """What tells sets apart: name, size and mark, or the place of a line whose name did not travel, as no other has its set."""
    name = entries["name"] & SENT
    found = mix(name + mix(entries["mark"] + entries["n"].astype(np.uint64)))
    alone = np.flatnonzero(name == 0)
    found[alone] = hash_keys(*(entries[c][alone] for c in PLACE))
    return found


def first_of_each(entries: np.ndarray) -> np.ndarray:
    """One entry per token and set, the earliest, in the order they have."""
    name = identity(entries)
    named = mix(entries["token"] + name)
    order = np.argsort(named)
    named = named[order]
    same = named[1:] == named[:-1]
    if not same.any():
        return entries
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    at = order[several]
    some = entries[at]
    sorted_ = np.lexsort((some["place"], some["line"], some["body"], some["key"], name[at], some["token"]))
    at, some = at[sorted_], some[sorted_]
    name, keep = name[at], np.ones(len(entries), bool)
    keep[at[1:]] = (some["token"][1:] != some["token"][:-1]) | (name[1:] != name[:-1])
    return entries[keep]


def with_company(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(entries, rank, size of the group)`` of tokens that several have, by token, then in the order of lines."""
    order = np.argsort(entries["token"])
    token = entries["token"][order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(token)))
    rank, counts = np.arange(len(token)) - np.repeat(starts, counts), np.repeat(counts, counts)
    several = counts > 1
    entries = entries[order[several]]
    order = np.lexsort((entries["line"], entries["body"], entries["key"], entries["token"]))
    return entries[order], rank[several], counts[several]


def may_match(entries: np.ndarray, rank: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the bounds of `possible` leave an entry any other of its token; in larger groups nothing is ruled out."""
    found = counts > SMALL_GROUP
    after = (entries["n"] - entries["place"]).astype(np.int64)
    n, mark = entries["n"].astype(np.int64), np.ascontiguousarray(entries["mark"])
    a = np.flatnonzero(~found)
    for step in range(1, SMALL_GROUP):
        a = a[rank[a] + step < counts[a]]
        if not len(a):
            break
        b = a + step
        both = n[a] + n[b]
        overlap = np.ceil(both * (threshold / (1 + threshold)) - 1e-9)
        open_ = (np.minimum(n[a], n[b]) >= np.maximum(n[a], n[b]) * threshold - 1e-9) & (np.minimum(after[a], after[b]) >= overlap)
        open_ &= np.bitwise_count(mark[a] ^ mark[b]) <= both - 2 * overlap
        found[a[open_]] = found[b[open_]] = True
    return found


def pack_entries(entries: np.ndarray) -> bytes:
    """Column by column, a column byte by byte, and compressed.

    Positions, which are in the order of the documents, and sizes compress well, hashes do not.
    """
    parts = []
    for field in ("key", *FIELDS):
        column = np.diff(entries["key"], prepend=np.int64(0)) if field == "key" else np.ascontiguousarray(entries[field])
        planes = column.view(np.uint8).reshape(len(entries), -1).T[UNSENT.get(field, 0) :]
        parts.append(pa.compress(planes.tobytes(), codec="zstd", asbytes=True))
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def unpack_entries(packed: bytes, count: int) -> np.ndarray:
    entries, at = np.empty(count, _ENTRY), 0
    for field in ("key", *FIELDS):
        size, kind, unsent = int.from_bytes(packed[at : at + 4], "little"), _ENTRY[field], UNSENT.get(field, 0)
        sent = kind.itemsize - unsent
        plain = pa.decompress(packed[at + 4 : at + 4 + size], decompressed_size=count * sent, codec="zstd", asbytes=True)
        column = np.zeros((count, kind.itemsize), np.uint8)
        column[:, unsent:] = np.frombuffer(plain, np.uint8).reshape(sent, count).T
        entries[field] = column.view(kind).ravel()
        at += 4 + size
    entries["key"] = np.cumsum(entries["key"])
    return entries


def packed_entries(docs: DataFrame, sketch: Sketch, threshold: float, copied: np.ndarray | None = None) -> DataFrame:
    """``bucket, count, entries`` of all prefixes: packed by bucket, a few large rows instead of many small ones.

    ``copied`` is a filter of the places of all lines whose set another document has; the names of others do not travel.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch.cells)
    listed = docs.sparkSession.sparkContext.broadcast(copied)
    buckets = 1 + int(sketch.cells[0].sum()) // BUCKET_SHINGLES

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, held, size = Sketch(shared.value), [], 0
        for batch in batches:
            keys, bodies = key_numbers(batch.column(0)), key_numbers(batch.column(2))
            for lines in line_sets(batch.column(1)):
                held.append(prefix_entries(*lines, keys, bodies, sketch, threshold, listed.value))
                size += len(held[-1])
                if size >= HELD_ENTRIES:
                    yield packed(held, sketch)
                    size = 0
        if size:
            yield packed(held, sketch)

    def packed(held: list[np.ndarray], sketch: Sketch) -> pa.RecordBatch:
        """Takes what is held, which is copied once for all and once bucket by bucket."""
        entries = np.concatenate(held)
        held.clear()
        entries = first_of_each(entries)
        hot = sketch.counts(entries["token"]) > HOT_TOKEN
        entries["name"] = np.where(entries["name"] & np.uint64(1), entries["name"] & SENT, np.uint64(0))
        dealt_by = entries["token"].copy()
        dealt_by[hot] += identity(entries[hot])
        bucket = (mix(dealt_by) % np.uint64(buckets)).astype(np.int64) * 2 + hot
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 15 else bucket, kind="stable")
        numbers, starts = np.unique(bucket[order], return_index=True)
        groups = np.split(order, starts[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array([len(g) for g in groups], pa.int64()),
             pa.array([pack_entries(entries[g]) for g in groups], pa.binary())], ["bucket", "count", "entries"])

    return docs.mapInArrow(dealt, "bucket long, count long, entries binary")


def shared_tokens(docs: DataFrame, sketch: Sketch, threshold: float, copied: np.ndarray | None = None) -> DataFrame:
    """``token, key, body, line, n, place, mark, rank`` of the first line of each set, for prefix tokens that several sets have.

    Entries that the bounds leave no other line are dropped on arrival; ``rank`` counts the lines of a
    token, and is -1 for hot tokens, whose lines lie in many buckets.
    """

    def joined(table: pa.Table) -> pa.Table:
        arrived = [unpack_entries(p.as_py(), c.as_py()) for c, p in zip(table.column("count"), table.column("entries"))]
        entries, even = np.concatenate(arrived), table.column("bucket")[0].as_py() % 2 == 0
        entries = first_of_each(entries[repeated(entries["token"])] if even else entries)
        if even:  # a hot token has several lines for certain
            entries, rank, counts = with_company(entries)
            open_ = may_match(entries, rank, counts, threshold)
            entries, rank = entries[open_], rank[open_]
        else:
            rank = np.full(len(entries), -1)
        return pa.table({"token": entries["token"].astype(np.int64), "key": entries["key"], "body": entries["body"],
                         "line": entries["line"], "n": entries["n"], "place": entries["place"],
                         "mark": entries["mark"].astype(np.int64), "rank": rank})

    return packed_entries(docs, sketch, threshold, copied).groupBy("bucket").applyInArrow(
        joined, "token long, key long, body long, line int, n int, place int, mark long, rank long")


def possible(a: str, b: str, threshold: float) -> Column:
    """Length and positional bound, and that of the marks, for two entries of one token."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    overlap = F.ceil((n_a + n_b) * (threshold / (1 + threshold)) - 1e-9)
    after = F.least(n_a - F.col(f"{a}.place"), n_b - F.col(f"{b}.place"))
    differing = F.bit_count(F.col(f"{a}.mark").bitwiseXOR(F.col(f"{b}.mark")))
    return (F.least(n_a, n_b) >= F.greatest(n_a, n_b) * threshold - 1e-9) & (after >= overlap) & (differing <= n_a + n_b - 2 * overlap)


# ---- verification ------------------------------------------------------------------------------


def line_texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``key, body, line, text`` of the listed ``key, body, line`` and a few more, twice if rows are; ``docs`` has ``key, text, body``."""
    shared = docs.sparkSession.sparkContext.broadcast(members(lines.select(*PLACE)))

    def picked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bodies = key_numbers(batch.column(0)), key_numbers(batch.column(2))
            data, offsets = text_buffer(batch.column(1))
            for start, stop in chunks(offsets):
                own, bounds = data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
                if not len(own):
                    continue
                cuts, row, number = line_offsets(own, bounds)
                at = np.flatnonzero(contained(shared.value, hash_keys(keys[row + start], bodies[row + start], number)))
                texts = [own[cuts[i] : cuts[i + 1]].tobytes().decode() for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row[at] + start]), pa.array(bodies[row[at] + start]),
                     pa.array(number[at].astype(np.int32)), pa.array(texts, pa.string())], [*PLACE, "text"])

    return docs.mapInArrow(picked, "key long, body long, line int, text string")


def verify_lines(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``key, body, line, by_key, by_body, by_line`` of such pairs with the needed Jaccard similarity."""

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = np.concatenate([np.zeros(0, bool), *(
                jaccard_at_least(batch.column(6).slice(i, 2048), batch.column(7).slice(i, 2048), threshold)
                for i in range(0, len(batch), 2048))])
            keep = pa.array(similar)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in range(6)], [*PLACE, *BY_PLACE])

    def named(places: list[str]) -> DataFrame:  # most texts are in no pair of the round
        listed = members(pairs.select(F.xxhash64(*places)))
        return texts.filter(maybe_member(listed, F.xxhash64(*PLACE), texts)).dropDuplicates(PLACE)

    pairs = written(pairs, "pairs")
    by = named(BY_PLACE).toDF(*BY_PLACE, "by_text")
    both = pairs.join(named(PLACE), PLACE).join(by, BY_PLACE)
    return both.select(*PLACE, *BY_PLACE, "text", "by_text").mapInArrow(
        compared, "key long, body long, line int, by_key long, by_body long, by_line int")


def jaccard_at_least(a: pa.Array, b: pa.Array, threshold: float) -> np.ndarray:
    """Pairwise, on the shingle sets of the whole strings."""
    rows, values = [], []
    for column in (a, b):
        data, offsets = text_buffer(column)
        row, value, _ = distinct(*shingles(data, offsets))
        rows.append(row), values.append(value)
    sizes = sum(np.bincount(r, minlength=len(a)) for r in rows)
    _, _, count = both = distinct(np.concatenate(rows), np.concatenate(values))
    shared = np.bincount(both[0][count > 1], minlength=len(a))
    return shared >= threshold * (sizes - shared) - 1e-9


# ---- operator ----------------------------------------------------------------------------------


def similar_lines(docs: DataFrame, sketch: Sketch, threshold: float, copied: np.ndarray) -> DataFrame:
    """``key, body, line, by_key, by_body, by_line``: lines that are similar to an earlier one of another set, with one such line."""
    found = written(shared_tokens(docs, sketch, threshold, copied), "tokens")
    ranked, hot = found.filter("rank >= 0"), found.filter("rank < 0").drop("rank")
    if hot.take(1):
        ordered = written(hot.repartitionByRange("token", *PLACE).sortWithinPartitions("token", *PLACE), "ranked")
        ranked = ranked.unionByName(written(numbered(ordered, "token", "rank"), "postings"))
    texts = written(line_texts(docs, ranked.select(*PLACE).distinct()), "lines")
    matches, open_, low, high = [], ranked, 0, 1
    while True:
        first = ranked.filter((F.col("rank") >= low) & (F.col("rank") < high))
        pairs = open_.alias("a").join(first.alias("b"), F.col("a.token") == F.col("b.token")).filter(
            (F.col("b.rank") < F.col("a.rank")) & possible("a", "b", threshold)
        ).select(*(f"a.{c}" for c in PLACE), *(F.col(f"b.{c}").alias(f"by_{c}") for c in PLACE)).distinct()
        similar = written(verify_lines(pairs, texts, threshold), "matches")
        matches.append(similar)
        open_ = written(open_.filter(F.col("rank") > high).join(
            similar.select(*PLACE).distinct(), PLACE, "left_anti"), "open")
        if not open_.take(1):
            return reduce(DataFrame.unionByName, matches)
        low, high = high, NEXT_RANKS if high == 1 else 1 << 62


def row_place(docs: DataFrame, key: str, text: str) -> tuple[Column, Column]:
    """The key as a number, and the body: the hash of the text where several rows may have the key, or else 0."""
    number = F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY))
    several = members(docs.groupBy(number.alias("key")).count().filter("count > 1").select("key"))
    none, hashed = F.lit(0).cast("long"), F.xxhash64(F.col(text).cast("string"))
    return number, F.when(maybe_member(several, number, docs), hashed).otherwise(none) if several.any() else none


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, body, lines, by_keys`` of every document that loses lines: their numbers and the keys of earlier lines."""
    return _removed(docs, text, threshold, *row_place(docs, key, text))


def _removed(docs: DataFrame, text: str, threshold: float, number: Column, body: Column) -> DataFrame:
    plain = docs.select(number.alias("key"), F.col(text).cast("string").alias("text"), body.alias("body"))
    with workspace(docs.sparkSession):
        return written(_removed_lines(plain, threshold), "removed", keep=True)


def _removed_lines(plain: DataFrame, threshold: float) -> DataFrame:
    seen, sketch = occurrences(plain)
    names, new = ["name1", "name2"], seen.filter(~F.col("again"))
    first = new.groupBy(*names).agg(F.min("key").alias("by_key"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = written(new.join(first.drop("n"), names), "copies")
    # Rows of the first key: those of the first text's first line stay.
    ties, place = copies.filter("key = by_key"), F.struct("body", "line")
    stays = ties.groupBy(*names).agg(F.min(place).alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = seen.filter("again").withColumn("by_key", F.col("key"))
    similar = similar_lines(plain, sketch, threshold, members(copies.select(*PLACE)))
    parts = (gone, copies.filter("key <> by_key"), ties.join(stays.drop("n"), names).filter(place != F.col("stays")), similar)
    gone = reduce(DataFrame.unionByName, (part.select(*PLACE, "by_key") for part in parts))
    return gone.groupBy("key", "body").agg(F.array_sort(F.collect_set("line")).alias("lines"),
                                           F.array_sort(F.collect_set("by_key")).alias("by_keys"))


def squeezed(text: Column) -> Column:
    """Length and compressed bytes of each text, as they travel."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        plain = (None if x is None else x.encode() for x in texts.to_pylist())
        return pa.array([None if x is None else len(x).to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True)
                         for x in plain], pa.binary())

    return packed(text)


def without_lines(packed: Column, lines: Column) -> Column:
    """The texts again, without the listed lines."""

    @F.arrow_udf("string")
    def left(packed: pa.Array, lines: pa.Array) -> pa.Array:
        texts = []
        for one, gone in zip(packed.to_pylist(), lines.to_pylist()):
            text = None if one is None else pa.decompress(one[8:], int.from_bytes(one[:8], "little"), "zstd", asbytes=True).decode()
            if text is not None and gone:
                gone = set(gone)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            texts.append(text)
        return pa.array(texts, pa.string())

    return left(packed, lines)


def _shortened(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """The documents with shortened texts and ``__lines, __by`` (null where nothing went)."""
    number, body = row_place(docs, key, text)
    gone = _removed(docs, text, threshold, number, body).toDF("__number", "__body", "__lines", "__by")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn("__loses", maybe_member(
        members(gone.select(F.xxhash64("__number", "__body"))), F.xxhash64(number, body), docs))
    moved = marked.filter("__loses").withColumns({"__number": number, "__body": body}).withColumn(
        text, squeezed(F.col(text).cast("string")))
    joined = moved.join(gone, ["__number", "__body"], "left")
    changed = joined.withColumn(text, without_lines(F.col(text), F.col("__lines"))).select(*columns, "__lines", "__by")
    same = marked.filter(~F.col("__loses")).select(
        *columns, F.lit(None).cast("array<int>").alias("__lines"), F.lit(None).cast("array<bigint>").alias("__by"))
    return changed.unionByName(same)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with shortened texts, and ``removed_lines`` and ``removed_by`` (null where nothing went)."""
    plain = docs.drop("removed_lines", "removed_by")
    return _shortened(plain, key, text, threshold).withColumnsRenamed({"__lines": "removed_lines", "__by": "removed_by"})


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without repeated lines and with their own columns; one that has only such lines goes."""
    left = F.col("__lines").isNull() | F.col(text).rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")
    return _shortened(docs, key, text, threshold).filter(left).drop("__lines", "__by")
