"""Word shingles of many texts at once, on the bytes of Arrow columns, and counts of them in bounded memory."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SHINGLE_WORDS = 5
#: Bytes of text that are worked on at once; a longer text is one piece of work.
CHUNK_BYTES = 1 << 18
SKETCH_BITS, SKETCH_ROWS, SLICE_CELLS = 18, 2, 1 << 13
#: Values that a task holds before its sketch counts them.
HELD_VALUES = 1 << 18
SLICE_SCHEMA = "slice int, cells binary"

_random = np.random.default_rng(20240229)
#: Lower-cased byte of a word, 0 for what separates words: all of ASCII but letters and digits.
_BYTE = np.zeros(256, np.uint8)
_BYTE[128:] = np.arange(128, 256)
for _low, _high, _to in ((48, 58, 48), (97, 123, 97), (65, 91, 97)):
    _BYTE[_low:_high] = np.arange(_to, _to + _high - _low)
#: Two independent hashes: values of bytes, base, values of places.
_BYTE_VALUE = [_random.integers(1, 1 << 63, 256, np.uint64)]
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_PLACE = [_random.integers(1, 1 << 63, 16, np.uint64) | np.uint64(1)]
_second = np.random.default_rng(20240301)
_BYTE_VALUE.append(_second.integers(1, 1 << 63, 256, np.uint64))
_PLACE.append(_second.integers(1, 1 << 63, 16, np.uint64) | np.uint64(1))
_powers = [[np.ones(1, np.uint64), np.ones(1, np.uint64)] for _ in _BASE]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int, which: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    powers = _powers[which]
    if len(powers[0]) < n:
        size = max(n, CHUNK_BYTES * 2)
        for i, base in enumerate((_BASE[which], pow(_BASE[which], -1, 1 << 64))):
            powers[i] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]))
    return powers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    starts = starts.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes together."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(stop, rows)
        row = min(stop, rows)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and row, start and end of every word, in order. A word never runs over a row's end."""
    low = _BYTE[data]
    inside = low > 0
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # also marks the end of the data
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return low, np.searchsorted(offsets, starts, "right") - 1, starts, ends


def _word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    power, inverse = _power_table(len(low) + 1, which)
    values = _BYTE_VALUE[which][low]
    values *= power[: len(low)]
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``size`` words; fewer words, but not none, are one shingle."""
    row, (value,) = shingles_by(data, offsets, (which,), size)
    return row, value


def shingles_by(data: np.ndarray, offsets: np.ndarray, hashes: Iterable[int], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, list[np.ndarray]]:
    """The row of every shingle, and its values by each of the listed hashes."""
    low, row, starts, ends = _words(data, offsets) if len(data) else (data, *[np.zeros(0, np.int64)] * 3)
    if not len(row):
        return row, [np.zeros(0, np.uint64) for _ in hashes]
    n, count = len(row), np.bincount(row, minlength=len(offsets) - 1)
    whole = np.zeros(n, bool)
    whole[: max(n - size + 1, 0)] = row[size - 1 :] == row[: max(n - size + 1, 0)]
    begins = np.concatenate([[True], row[1:] != row[:-1]])
    start = np.flatnonzero(whole | (begins & (count[row] < size)))
    short = np.flatnonzero(~whole[start])
    of_short = start[short]
    found = []
    for which in hashes:
        word, place = _word_hashes(low, starts, ends, which), _PLACE[which]
        total = word * place[0]
        for k in range(1, min(size, n)):
            total[:-k] += word[k:] * place[k]
        total = total[start]
        own = word[of_short] * place[0]  # a short row has its own words only
        for k in range(1, size - 1):
            longer = np.flatnonzero(count[row[of_short]] > k)
            own[longer] += word[of_short[longer] + k] * place[k]
        total[short] = own
        found.append(mix(total))
    return row[start], found


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, value, count)`` sorted by row and value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if not len(row):
        return row, value, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])]))
    return row[new], value[new], np.diff(np.append(new, len(row)))


def distinct_tokens(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, token)`` sorted and without repeats; a token is a value's first 44 bits, so one plain sort does.

    For at most 2**20 rows. Within a row of a million shingles two would share a token with a probability of 3 %.
    """
    if not len(row):
        return row, value
    packed = (row.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
    packed.sort()
    packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
    return (packed >> np.uint64(44)).astype(np.int64), packed << np.uint64(20)


# ---- counts ------------------------------------------------------------------------------------


class Sketch:
    """Estimated counts of 64-bit values in fixed memory: a count-min sketch whose cells are freed of mean noise.

    Every value is counted. Frequent values stand out at any size of the corpus; an estimate
    is a function of the value alone, so it is the same wherever it is asked for.
    """

    def __init__(self, cells: np.ndarray | None = None) -> None:
        self.cells = np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int64) if cells is None else cells

    @staticmethod
    def cell(row: int, values: np.ndarray) -> np.ndarray:
        return ((values >> np.uint64(64 - SKETCH_BITS * (row + 1))) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)

    def add(self, values: np.ndarray) -> None:
        for row in range(SKETCH_ROWS):
            self.cells[row] += np.bincount(self.cell(row, values), minlength=1 << SKETCH_BITS)

    def slices(self) -> Iterator[pa.RecordBatch]:
        """What a task hands on to `added_up`."""
        return _slices(self.cells.reshape(-1, SLICE_CELLS), range(self.cells.size // SLICE_CELLS))

    def noise(self) -> float:
        """Standard deviation of an estimate of a rare value."""
        return float(np.sqrt(self.cells[0].sum() / self.cells.shape[1]))

    def counts(self, values: np.ndarray) -> np.ndarray:
        found = None
        for row, cells in enumerate(self.cells):
            own = cells[self.cell(row, values)]
            noise = (cells.sum() - own) / (len(cells) - 1)
            found = own - noise if found is None else np.minimum(found, own - noise)
        return np.maximum(found, 1.0)


class Held:
    """Values on their way to a sketch, which takes long runs at less cost than short ones."""

    def __init__(self) -> None:
        self.values, self.size = [], 0

    def add(self, values: np.ndarray, sketch: Sketch) -> None:
        self.values.append(values)
        self.size += len(values)
        if self.size >= HELD_VALUES:
            self.flush(sketch)

    def flush(self, sketch: Sketch) -> None:
        if self.size:
            sketch.add(np.concatenate(self.values))
        self.values, self.size = [], 0


def sketch_of(rows: DataFrame, values_of) -> Sketch:
    """The sketch of all values that ``values_of(batch)`` yields, added up by Spark slice by slice."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, held = Sketch(), Held()
        for batch in batches:
            for values in values_of(batch):
                held.add(values, sketch)
        held.flush(sketch)
        yield from sketch.slices()

    return added_up(rows.mapInArrow(counted, SLICE_SCHEMA))


def added_up(slices: DataFrame) -> Sketch:
    """The sum of sketches that tasks have yielded as ``slice, cells``."""

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(number, np.zeros(SLICE_CELLS, np.int64))
                own += np.frombuffer(cells.as_buffer(), np.int32)
        yield from _slices(np.array(list(sums.values()), np.int64), list(sums), np.int64)

    n_slices = SKETCH_ROWS * (1 << SKETCH_BITS) // SLICE_CELLS
    merged = slices.repartition(n_slices, "slice").mapInArrow(added, SLICE_SCHEMA)
    sketch = Sketch()
    flat = sketch.cells.reshape(-1, SLICE_CELLS)
    for r in merged.collect():  # a fixed number of cells, whatever the input
        flat[r["slice"]] = np.frombuffer(r["cells"], np.int64)
    return sketch


def _slices(cells: np.ndarray, numbers: Iterable[int], kind=np.int32) -> Iterator[pa.RecordBatch]:
    kept = [(n, c.astype(kind).tobytes()) for n, c in zip(numbers, cells) if c.any()]
    if kept:
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in kept], pa.int32()), pa.array([c for _, c in kept], pa.binary())], ["slice", "cells"]
        )
