"""Stock continuity while the moves are still streaming."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulse.functions.columns import is_type

_MOVE = "moved_at long, event_id string, warehouse_id string, delta_qty int, stock_after int"
_FIELDS = [field.split()[0] for field in _MOVE.split(", ")]
_OUT = f"product_id string, {_MOVE}, previous_stock int"
#: Nameless moves have no previous level and so no state; they are dealt over this many keys.
NAMELESS_PIECES = 64
#: Moves that come out in one frame, but for the rest of a stretch.
ROWS_PER_FRAME = 10_000
#: Slices whose moves wait in one entry of the state.
SLICES_TOGETHER = 360


def _place(move: tuple) -> tuple:
    """Order of moves: time, then id, a missing id first."""
    return move[0], move[1] is not None, move[1] or ""


class StockLevels(StatefulProcessor):
    """Moves of one product wait until the watermark has passed their slice of time, and then come out in order.

    State is the last level and the waiting moves, in one entry per stretch of many slices. One timer, at the end of the
    earliest slice that waits, releases all that are due at once, so the calls to the state follow the stretches of a
    batch and not its slices, and no more than the moves of one stretch are held at a time. A move that belongs before one
    that has come out already (its producer's clock was behind its event time) comes out at once, without a previous level.
    """

    def __init__(self, slice_ms: int) -> None:
        self.slice_ms = slice_ms
        self.stretch_ms = slice_ms * SLICES_TOGETHER

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        entry = ",".join(field.replace(" ", ":") for field in _MOVE.split(", "))
        self._waiting = handle.getMapState("waiting", "stretch long", f"moves array<struct<{entry}>>")
        self._last = handle.getValueState("last", "moved_at long, event_id string, stock_after int")
        self._timer = handle.getValueState("timer", "slice_end long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            for frame in rows:
                yield _frame(None, [(*move, None) for move in _moves(frame)])
            return
        last = tuple(self._last.get()) if self._last.exists() else None
        stretches: dict[int, list[tuple]] = {}
        too_late = []
        for frame in rows:
            for move in _moves(frame):
                if last is not None and _place(move) < _place(last):
                    too_late.append((*move, None))
                else:
                    stretches.setdefault(self._stretch(move), []).append(move)
        known = {stretch for (stretch,) in self._waiting.keys()} if stretches else set()
        for stretch, new in stretches.items():
            old = self._waiting.getValue((stretch,))[0] if stretch in known else []
            self._waiting.updateValue((stretch,), ([tuple(m) for m in old] + new,))
        if stretches:
            self._wake(min(self._slice_end(move) for move in stretches[min(stretches)]))
        yield _frame(key[0], too_late)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        last = tuple(self._last.get()) if self._last.exists() else None
        found: list[tuple] = []
        for stretch in sorted(stretch for (stretch,) in self._waiting.keys()):
            if stretch * self.stretch_ms + self.slice_ms > watermark:  # not even its first slice
                self._wake_for(self._waiting.getValue((stretch,))[0])
                break
            moves = [tuple(m) for m in self._waiting.getValue((stretch,))[0]]
            due = sorted((m for m in moves if self._slice_end(m) <= watermark), key=_place)
            for move in due:
                found.append((*move, None if last is None else last[2]))
                last = move[0], move[1], move[4]
            if len(found) >= ROWS_PER_FRAME:
                yield _frame(key[0], found)
                found = []
            if len(due) < len(moves):
                open_moves = [m for m in moves if self._slice_end(m) > watermark]
                self._waiting.updateValue((stretch,), (open_moves,))
                self._wake_for(open_moves)
                break  # what follows is later still
            self._waiting.removeKey((stretch,))
        if last is not None:
            self._last.update(last)
        yield _frame(key[0], found)

    def _slice_end(self, move: tuple) -> int:
        return (move[0] // 1000 // self.slice_ms + 1) * self.slice_ms

    def _stretch(self, move: tuple) -> int:
        return move[0] // 1000 // self.stretch_ms

    def _wake_for(self, moves: list[tuple]) -> None:
        self._wake(min(self._slice_end(move) for move in moves))

    def _wake(self, slice_end: int) -> None:
        """One timer, at the earliest slice that waits."""
        if self._timer.exists():
            (registered,) = self._timer.get()
            if registered <= slice_end:
                return
            self._handle.deleteTimer(registered)
        self._handle.registerTimer(slice_end)
        self._timer.update((slice_end,))

    def close(self) -> None:
        pass


def _moves(frame: pd.DataFrame) -> Iterator[tuple]:
    return map(_plain, frame[_FIELDS].itertuples(index=False, name=None))


def _plain(move: tuple) -> tuple:
    moved_at, event_id, warehouse_id, delta, stock = (None if pd.isna(value) else value for value in move)
    return int(moved_at), event_id, warehouse_id, *(None if n is None else int(n) for n in (delta, stock))


def _frame(product: str | None, rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[*_FIELDS, "previous_stock"], dtype=object)
    frame.insert(0, "product_id", product)
    return frame.astype({"moved_at": "int64"} | dict.fromkeys(("delta_qty", "stock_after", "previous_stock"), "Int32"))


def stock_continuity_stream(events: DataFrame, slice_seconds: int = 10) -> DataFrame:
    """The rows of `stock_continuity` for a stream of `normalize_events`, in whatever order its moves arrive.

    A move comes out when the watermark, which follows the event time of inventory events, has passed the end of its slice of
    producer time. Until then later batches can bring moves that belong before it. What comes
    later than the watermark allows is dropped, as everywhere. Needs the RocksDB state store.
    """
    moves = events.filter(is_type("inventory_updated")).select(
        "event_ts", "product_id", F.unix_micros(F.coalesce("producer_ts", "event_ts")).alias("moved_at"), *_FIELDS[1:])
    piece = F.when(F.col("product_id").isNull(), F.pmod(F.xxhash64("event_id", "moved_at"), F.lit(NAMELESS_PIECES))).otherwise(0)
    ordered = moves.withColumn("piece", piece).groupBy("product_id", "piece").transformWithStateInPandas(
        StockLevels(slice_seconds * 1000), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    explained = F.col("previous_stock") + F.col("delta_qty") == F.col("stock_after")
    return ordered.withColumn("moved_at", F.timestamp_micros("moved_at")).withColumn("is_continuous", explained)
