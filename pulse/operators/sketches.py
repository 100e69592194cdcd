"""Mergeable summaries of short windows, from which every longer window follows without the events.

A row per window holds the number of events, a distinct-count sketch of their users and a
quantile sketch of their producer lag. Stored per minute, rows of five minutes, hours or days are
unions of minutes. Sketches of a window are the same whether they were made of events or of
parts, so parts may come from different tasks, batches or days. All of it is partial aggregation over rows of
bounded size: a busy window is one row per task in the shuffle.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.config import JobConfig

#: Binary logarithm of a user sketch's registers: 4 KiB a window at most.
USER_REGISTERS_LOG = 12
#: Size of a lag sketch; its ranks are wrong by some 1.7 % of the events at most (99 % confidence).
LAG_SIZE = 200
LAG_RANK_ERROR = 0.0165
SKETCH_COLUMNS = ("window_start", "window_end", "n_events", "users_sketch", "lag_sketch")


def window_sketches(events: DataFrame, config: JobConfig = JobConfig(), registers_log: int = USER_REGISTERS_LOG) -> DataFrame:
    """Normalised events to one row per window, batch or stream. Events without user or producer time add to neither sketch."""
    lag = (F.unix_micros("producer_ts") - F.unix_micros("event_ts")) / 1_000_000
    grouped = events.select("event_ts", "user_id", lag.alias("lag")).groupBy(
        F.window("event_ts", config.window_duration, config.slide_duration).alias("window"))
    made = grouped.agg(
        F.count(F.lit(1)).alias("n_events"), F.hll_sketch_agg("user_id", registers_log).alias("users_sketch"),
        F.kll_sketch_agg_double("lag", LAG_SIZE).alias("lag_sketch"),
    )
    return _flat(made)


def roll_up(sketches: DataFrame, duration: str, slide: str | None = None) -> DataFrame:
    """Rows of longer windows, tumbling or sliding, from rows of windows that fit into them."""
    grouped = sketches.groupBy(F.window("window_start", duration, slide or duration).alias("window"))
    made = grouped.agg(
        F.sum("n_events").alias("n_events"), F.hll_union_agg("users_sketch").alias("users_sketch"),
        F.kll_merge_agg_double("lag_sketch", LAG_SIZE).alias("lag_sketch"),
    )
    return _flat(made)


def _flat(made: DataFrame) -> DataFrame:
    ends = (F.col(f"window.{end}").alias(f"window_{end}") for end in ("start", "end"))
    return made.select(*ends, *SKETCH_COLUMNS[2:])


def active_users(sketch: Column) -> Column:
    """Estimated users of a sketch.

    A sketch that has seen events one by one estimates from their order; the union with itself
    leaves its registers alone, which are all that merged sketches have in common.
    """
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))


def lag_quantiles(sketch: Column, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, quantiles)))


def users_error(registers_log: int = USER_REGISTERS_LOG) -> float:
    """Relative standard error of a merged user sketch."""
    return 1.04 / sqrt(1 << registers_log)


def within_errors(estimate: Column, exact: Column, error: float, errors: float = 3.0) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count; one user off is always allowed."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(errors * error) * exact)
