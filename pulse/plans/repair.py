"""Metric windows that miss events, found by their counts and computed again.

Late events are dropped by the streaming aggregation, and rejected ones are readmitted after their time. Both
are in the archive but not in the metric table. Only windows whose counts differ are computed again, from
the archive, and written as a run of their own, which readers prefer as the later version.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.functions.columns import instant
from pulse.operators.metrics import METRICS, Metric, build_metrics, named
from pulse.sinks.metric_table import write_metric_table

WINDOW = ["window_start", "window_end"]


def uncounted(
    events: DataFrame, metrics: DataFrame, config: JobConfig = JobConfig(), until: datetime | None = None,
) -> DataFrame:
    """``window_start, window_end, event_type, n_events, n_counted`` of windows and types whose counts differ.

    ``events`` are all normalised events, ``metrics`` the table with ``events_per_minute``; both of the same range of
    time. Windows that end after ``until`` are left out; by default all that end after the table's last one,
    since a stream has not written them yet.
    """
    key = [*WINDOW, "dimension_value"]
    counted = metrics.filter(F.col("metric_name") == "events_per_minute").select(*key, F.col("metric_value").alias("n_counted"))
    actual = build_metrics(events, config, named("events_per_minute")).select(*key, F.col("metric_value").alias("n_events"))
    if until is None:
        last = metrics.agg(F.max("window_end").alias("last"))
        actual = actual.join(last, F.col("window_end") <= F.col("last")).drop("last")
    else:
        actual, counted = (rows.filter(F.col("window_end") <= instant(until)) for rows in (actual, counted))
    # A missing type is a group of its own, which an ordinary equality would not join.
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]
    joined = actual.alias("a").join(counted.alias("c"), same, "left")
    number = lambda name: F.coalesce(F.col(name), F.lit(0.0)).cast("long").alias(name)
    found = joined.select(*(F.col(f"a.{k}").alias(k) for k in key), number("n_events"), number("n_counted"))
    return found.filter(F.col("n_events") != F.col("n_counted")).withColumnRenamed("dimension_value", "event_type")


def metrics_of_windows(
    events: DataFrame, windows: DataFrame, config: JobConfig = JobConfig(), metrics: Sequence[Metric] = METRICS,
) -> DataFrame:
    """Metric rows of the given windows alone; events of no such window do not reach the aggregation."""
    wanted = windows.select(*WINDOW).distinct()
    # The metrics find an event's windows themselves, so it has to come once, however many of them are wanted.
    # Windows are made of slides; an event lies in one of these.
    slide = F.expr(f"INTERVAL {config.slide_duration}")
    slides = wanted.select(F.explode(F.sequence("window_start", F.col("window_end") - slide, slide)).alias("__slide")).distinct()
    own = F.window("event_ts", config.slide_duration).start.alias("__slide")
    touched = events.select("*", own).join(slides, "__slide", "left_semi").drop("__slide")
    return build_metrics(touched, config, metrics).join(wanted, WINDOW, "left_semi")


def repair(
    events: DataFrame, windows: DataFrame, path: str, run_id: str,
    config: JobConfig = JobConfig(), metrics: Sequence[Metric] = METRICS,
) -> None:
    """Write the given windows anew into the metric table; only their days get files."""
    write_metric_table(metrics_of_windows(events, windows, config, metrics), path, run_id=run_id)
