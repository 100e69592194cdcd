"""How filters interact: what each removes, and what it would remove, in every order.

A row's failures are a bit mask, so all rows of a part are counted by mask first, with partial
aggregation. The rest works on those counts. A mask matrix holds 0 where a mask fails a filter
and infinity elsewhere; a position matrix holds, for each order, the inverse permutation: at
which step each filter is applied. Their min-plus product is the step at which an order
removes a mask. These ranks say into which (order, step) the counts of a mask are scattered, so
each measure is one product of the counts with a fixed matrix.

Repeated texts: a row fails when its text stands under a smaller key anywhere in the table. Rows
are aggregated to (text, key, part), the smallest key of each text is found by aggregation, and
a join on text **and** key marks the first copies. All other rows are repeats, so no task ever
meets the copies of one text together.

Defined cases: a null text is empty (no words: fails ``short`` alone, and is a copy of other
empty texts); a row with a null key is never a repeat, makes no other a repeat and has no label;
repeated rows (same key and text) are all first copies or all repeats; a null part is the empty
string; a key with several label rows has a label if one of them has it; an empty table gives an
empty result. Texts of any length are read in one piece. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pulse.llm.shared import written

FEWEST_WORDS = 50
FEWEST_DISTINCT_PER_CENT = 65
MOST_CAPITALS_PER_CENT = 5
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))
#: Filters in the order of their bits; the last one looks at the whole table.
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")


def text_mask(text: bytes) -> int:
    """Bits of the filters that look at one UTF-8 text alone; ``split()`` of bytes knows the blanks of ASCII only."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    characters = len(text.translate(None, CONTINUATION))
    short = len(words) < FEWEST_WORDS
    dull = 100 * len(set(words)) < FEWEST_DISTINCT_PER_CENT * len(words)
    loud = 100 * capitals > MOST_CAPITALS_PER_CENT * characters
    symbols = len(text.translate(None, SYMBOLS)) < len(text)
    return short | dull << 1 | loud << 2 | symbols << 3


def text_failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``__key, part, mask, __hash1, __hash2``: a row's failures by its own text, and the text's identity."""
    given = docs.select(
        F.col(key).alias("__key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("__text"),
    )
    fields = [given.schema["__key"], StructField("part", StringType()), StructField("mask", IntegerType()),
              StructField("__hash1", LongType()), StructField("__hash2", LongType())]

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, names = np.zeros(batch.num_rows, "i4"), np.zeros((batch.num_rows, 2), "<i8")
            for row, value in enumerate(batch.column(2)):
                value = value.as_py()
                masks[row] = text_mask(value)
                names[row] = np.frombuffer(xxhash.xxh3_128_digest(value), "<i8")
            columns = [batch.column(0), batch.column(1), pa.array(masks), pa.array(names[:, 0]), pa.array(names[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return given.mapInArrow(measured, StructType(fields))


def mask_counts(
    docs: DataFrame, labels: DataFrame, marks: dict[str, Column],
    key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """``part, mask, n`` and a count for each mark of ``labels``, for the five filters."""
    copies = ["__hash1", "__hash2", "__key"]
    rows = written(text_failures(docs, key, text, part).groupBy(*copies, "part", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")
    marked = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        *(F.max(F.coalesce(mark, F.lit(False)).cast("long")).alias(name) for name, mark in marks.items()))
    # Null keys have no label: they stay out of the join, where they would all be one group.
    found = rows.filter(F.col("__key").isNotNull()).join(marked, "__key", "left").select(
        *rows.columns, *(F.coalesce(name, F.lit(0)).alias(name) for name in marks))
    keyless = rows.filter(F.col("__key").isNull()).select("*", *(F.lit(0).cast("long").alias(name) for name in marks))
    rows = written(found.unionByName(keyless), "audited")

    keyed = rows.filter(F.col("__key").isNotNull())
    first = keyed.groupBy("__hash1", "__hash2").agg(F.min("__key").alias("__key")).withColumn("__first", F.lit(True))
    counted = (F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col(name)).alias(name) for name in marks))
    repeated = F.when(F.col("__first").isNull(), F.lit(REPEATED)).otherwise(0)
    of_keyed = keyed.join(first, copies, "left").withColumn("mask", F.col("mask") + repeated)
    both = of_keyed.drop("__first").unionByName(rows.filter(F.col("__key").isNull()))
    return both.groupBy("part", "mask").agg(*counted)


def removal_ranks(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Step from 0 at which each order removes each mask, or the number of filters where none does: a min-plus product."""
    n = orders.shape[1]
    never = np.int64(n)
    failing = (masks[:, None] >> np.arange(n)) & 1
    cost = np.where(failing == 1, 0, never)
    position = np.argsort(orders, axis=1)
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), never)


class Scatter:
    """The matrices that turn counts by mask into counts by (order, step)."""

    def __init__(self, filters: str) -> None:
        n = len(filters)
        self.orders = np.array(list(permutations(range(n))), np.int64)
        self.names = ["".join(filters[i] for i in order) for order in self.orders]
        masks = np.arange(1 << n)
        ranks = removal_ranks(masks, self.orders)
        steps = np.arange(n)
        here = ranks[:, :, None] == steps
        fails = ((masks[:, None, None] >> self.orders[None]) & 1) == 1  # the filter of each step
        size = (len(masks), -1)
        self.removed = here.reshape(size).astype(np.int64)
        self.kept = (ranks[:, :, None] > steps).reshape(size).astype(np.int64)
        self.redundant = (fails & (ranks[:, :, None] < steps)).reshape(size).astype(np.int64)
        self.alone = (masks[:, None] == 1 << self.orders.reshape(-1)).astype(np.int64)
        self.of_filter = (self.orders.reshape(-1)[:, None] == steps).astype(np.int64)


def audit_interactions(counts: DataFrame, filters: str = FILTERS, marks: Sequence[str] = ()) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, <mark>_lost..., shapley`` from counts by mask.

    ``counts`` has ``part, mask, n`` and a count for each mark. Every part gets a row for each
    step of each order, zeros included. A part's counts have one entry for each mask, so a row holds them.
    """
    measures = ("n", *marks)
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *measures)).alias("counts"))
    by_part = by_part.select("part", F.col("counts.mask").alias("mask"), *(F.col(f"counts.{m}").alias(m) for m in measures))
    results = ("kept", "removed", "redundant", "unique_fails", *(f"{m}_lost" for m in marks), "shapley")
    schema = StructType([StructField("part", StringType()), StructField("filter_order", StringType()),
                         StructField("step", IntegerType()), *(StructField(name, LongType()) for name in results)])

    def scattered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = Scatter(filters)
        n, steps = len(filters), matrix.orders.size
        orders = pa.array(np.repeat(matrix.names, n))
        numbers = pa.array(np.tile(np.arange(1, n + 1, dtype="i4"), len(matrix.names)))
        for batch in batches:
            for row in range(batch.num_rows):
                at = np.array(batch.column(1)[row].as_py())
                weight = np.zeros((len(measures), 1 << n), np.int64)
                for m, column in enumerate(batch.columns[2:]):
                    np.add.at(weight[m], at, column[row].as_py())
                removed = weight @ matrix.removed
                shapley = matrix.of_filter @ (removed[0] @ matrix.of_filter)
                values = (weight[0] @ matrix.kept, removed[0], weight[0] @ matrix.redundant, weight[0] @ matrix.alone,
                          *removed[1:], shapley)
                part = pa.array([batch.column(0)[row].as_py()] * steps, pa.string())
                yield pa.RecordBatch.from_arrays([part, orders, numbers, *map(pa.array, values)], schema.fieldNames())

    return by_part.mapInArrow(scattered, schema)


def audit_filters(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """The audit of the five filters over a corpus, with the good and toxic rows that each step loses."""
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    return audit_interactions(mask_counts(docs, labels, marks, key, text, part), FILTERS, list(marks))
