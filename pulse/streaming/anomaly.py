"""Anomaly scores of metric windows as they close."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulse.plans.insights import LEAST_DEVIATION, SERIES, seconds_of

_IN = ["window_micros", "end_micros", "metric_value"]
_SERIES = "metric_name string, dimension_key string, dimension_value string"
_OUT = f"{_SERIES}, window_micros long, end_micros long, metric_value double, n_history long, mean double, deviation double, z_score double"


class RecentHistory(StatefulProcessor):
    """Each series remembers the values of its last windows, as many as the history holds at most, and nothing else.

    Windows close in order, so a value is scored against what the ring holds when it arrives, and then enters it.
    """

    def __init__(self, reach_micros: int) -> None:
        self.reach = reach_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._ring = handle.getValueState("ring", "starts array<long>, metric_values array<double>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        ring = deque(zip(*self._ring.get())) if self._ring.exists() else deque()
        arrived = sorted((row for frame in rows for row in frame[_IN].itertuples(index=False, name=None)), key=lambda row: row[0])
        found = []
        for start, end, value in arrived:
            while ring and ring[0][0] < start - self.reach:
                ring.popleft()
            found.append((*key, start, end, value, *_score(value, [v for at, v in ring if at < start])))
            ring.append((int(start), float(value)))
        self._ring.update(tuple(map(list, zip(*ring))))
        yield pd.DataFrame(found, columns=[field.split()[0] for field in _OUT.split(", ")])

    def close(self) -> None:
        pass


def _score(value: float, history: list[float]) -> tuple[int, float | None, float | None, float | None]:
    if not history:
        return 0, None, None, None
    mean = sum(history) / len(history)
    if len(history) == 1:
        return 1, mean, None, None
    deviation = (sum((x - mean) ** 2 for x in history) / (len(history) - 1)) ** 0.5
    spread = deviation > LEAST_DEVIATION * abs(mean)
    return len(history), mean, deviation, (value - mean) / deviation if spread else None


def anomaly_score_stream(metrics: DataFrame, history: str = "30 minutes") -> DataFrame:
    """The rows of `anomaly_scores` for a stream of metric rows, as `build_metrics` emits them in append mode.

    State is one ring per series, of one entry for each window of the history. Needs the RocksDB state store.
    """
    rows = metrics.select(*SERIES, F.unix_micros("window_start").alias("window_micros"), F.unix_micros("window_end").alias("end_micros"),
                          "metric_value")
    scored = rows.groupBy(*SERIES).transformWithStateInPandas(
        RecentHistory(seconds_of(history) * 1_000_000), outputStructType=_OUT, outputMode="Append", timeMode="None")
    return scored.select(
        F.timestamp_micros("window_micros").alias("window_start"), F.timestamp_micros("end_micros").alias("window_end"),
        *SERIES, "metric_value", "n_history", "mean", "deviation", "z_score")
