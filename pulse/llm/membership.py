"""A filter of integer keys that keeps rows without a partner out of a shuffle.

Two bits for each key in a bit array of about sixteen for each, ``MOST_BITS`` at most: with
more keys than that it lets more and more rows through that a join drops later, but never
keeps a listed key out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.shingles import mix

#: The number that stands for a null key.
LAST_KEY = (1 << 63) - 1
LEAST_BITS, MOST_BITS, SLICE_BITS = 1 << 16, 1 << 28, 1 << 16


def key_numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST_KEY).to_numpy(zero_copy_only=False)


def hash_keys(*columns: np.ndarray) -> np.ndarray:
    total = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        total = mix(total + column.astype(np.int64).view(np.uint64) + np.uint64(1))
    return total


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def members(keys: DataFrame) -> np.ndarray:
    """The packed bits of all columns' integer keys together, put together by Spark slice by slice."""
    bits, needed = LEAST_BITS, min(16 * keys.count(), MOST_BITS)
    while bits < needed:
        bits *= 2

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_ = np.zeros(bits, bool)
        for batch in batches:
            for place in _places(hash_keys(*map(key_numbers, batch.columns)), bits):
                set_[place] = True
        slices = set_.reshape(-1, SLICE_BITS)
        used = np.flatnonzero(slices.any(axis=1))
        for i in used:
            yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([np.packbits(slices[i]).tobytes()])],
                                             ["slice", "bits"])

    def united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(number, np.zeros(SLICE_BITS // 8, np.uint8))
                own |= np.frombuffer(part.as_buffer(), np.uint8)
        for number, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([own.tobytes()])], ["slice", "bits"])

    schema = "slice int, bits binary"
    merged = keys.mapInArrow(marked, schema).repartition(bits // SLICE_BITS, "slice").mapInArrow(united, schema)
    packed = np.zeros((bits // SLICE_BITS, SLICE_BITS // 8), np.uint8)
    for r in merged.collect():  # MOST_BITS at most
        packed[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return packed.ravel()


def contained(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for place in _places(hashes, len(packed) * 8):
        found &= (packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0
    return found


def maybe_member(packed: np.ndarray, key: Column, rows: DataFrame) -> Column:
    """Whether the filter lets an integer key through; ``rows`` says in which session."""
    shared = rows.sparkSession.sparkContext.broadcast(packed)

    @F.arrow_udf("boolean")
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array(contained(shared.value, hash_keys(key_numbers(keys))))

    return known(key.cast("long"))
