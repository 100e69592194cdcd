"""Shards by a hierarchical weighted hash tree.

A tree has regions, racks and shards. A row descends from the root: at each node every
child draws ``-ln(u) / weight`` from a hash of the row's key and the child's name, and the
smallest draw wins, so a child gets its share of the rows by weight. A draw depends on
nothing but key, name and weight. Changing weights below a node therefore moves rows
between that node's children only, and if the node's own weight stays, none enter or leave
it; a child that is added takes rows into itself and moves none between the others.

Defined cases: rows with the same key share a shard, rows without a key do too; a text
that is null has no bytes and the checksum 0; an empty table gives an empty result. Only
the key and the text are read, so further columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.shared import numbered, written

#: Bytes that a stored row takes besides its text.
ROW_OVERHEAD = 8
RACKS_PER_REGION, SHARDS_PER_RACK = 3, 4
#: Shards that a fleet starts with, in full racks and regions; those added later get a region each.
INITIAL_SHARDS = 24


@dataclass(frozen=True)
class Node:
    """A shard if it has a number, else a region, rack or root."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight

    def inner_levels(self) -> list[list[Node]]:
        levels, level = [], [self]
        while level:
            levels.append([node for node in level if node.children])
            level = [child for node in level for child in node.children]
        return [nodes for nodes in levels if nodes]

    def leaves(self) -> list[Node]:
        return [leaf for child in self.children for leaf in child.leaves()] if self.children else [self]


def shard_tree(shards: int, weights: dict[int, float] | None = None, initial: int = INITIAL_SHARDS) -> Node:
    """Shards 0 to ``shards - 1``: the initial ones in racks of 4 and regions of 3 racks, of which the last may be smaller.

    The tree of one shard more is always this one with a region added, which leaves the weights of all
    other subtrees as they are: rows move into the new shard only, however often a fleet grows. A
    fleet that starts with fewer shards than ``initial`` is given its own number there when it grows.
    """
    if shards < 1:
        raise ValueError("a tree needs at least one shard")
    weights, first = weights or {}, min(shards, initial)
    leaves = [Node(f"shard{i}", shard=i, own_weight=weights.get(i, 1.0)) for i in range(first)]
    racks = [Node(f"rack{i // SHARDS_PER_RACK}", tuple(leaves[i : i + SHARDS_PER_RACK]))
             for i in range(0, first, SHARDS_PER_RACK)]
    regions = [Node(f"region{i // RACKS_PER_REGION}", tuple(racks[i : i + RACKS_PER_REGION]))
               for i in range(0, len(racks), RACKS_PER_REGION)]
    tree = Node("root", tuple(regions))
    for i in range(first, shards):
        tree = grown_tree(tree, weights.get(i, 1.0))
    return tree


def grown_tree(tree: Node, weight: float = 1.0) -> Node:
    """One more shard in a region of its own: all other subtrees keep their weights, so rows move only into it."""
    number = len(tree.leaves())
    rack = Node(f"rack-of-{number}", (Node(f"shard{number}", shard=number, own_weight=weight),))
    return Node(tree.name, (*tree.children, Node(f"region-of-{number}", (rack,))))


def with_shard(df: DataFrame, keys: list[str], tree: Node, name: str) -> DataFrame:
    """Append the shard that each row's key descends to."""
    key, levels = [F.col(k) for k in keys], tree.inner_levels()
    below = F.create_map(*[x for nodes in levels for node in nodes for x in (
        F.lit(node.name),
        F.array(*[F.struct(F.lit(child.name).alias("name"), F.lit(float(child.weight)).alias("weight"))
                  for child in node.children if child.weight > 0]),
    )])

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(child["name"], *key), 11)
        uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((-F.log(uniform) / child["weight"]).alias("draw"), child["name"].alias("name"))

    at = F.lit(tree.name)
    for _ in levels:
        drawn = F.array_min(F.transform(F.try_element_at(below, at), draw))
        at = F.coalesce(drawn["name"], at)  # a shard has nothing below it
    number = F.create_map(*[F.lit(x) for leaf in tree.leaves() for x in (leaf.name, leaf.shard)])
    return df.withColumn(name, F.try_element_at(number, at).cast("int"))


def shard_documents(
    docs: DataFrame, shards: int = 24, weights: dict[int, float] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown_shard`` of every row.

    ``slot`` numbers the rows of a shard from 0 without gaps; ``grown_shard`` is the place
    with one more shard. The assigned rows are written once and numbered file by file, so
    no shard is gathered in one task.
    """
    tree = shard_tree(shards, weights)
    bytes_ = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    rows = docs.select(
        key,
        (bytes_ + ROW_OVERHEAD).alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    placed = with_shard(with_shard(rows, [key], tree, "shard"), [key], grown_tree(tree), "grown_shard")
    return numbered(written(placed, "shards"), "shard", "slot")
