"""Dashboard queries over the metric table, with explicit time bounds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.functions.columns import between_instants

# The panels of the overview dashboard: metric, unit and form. Fixed values.
PANELS = {
    "Revenue per Minute": ("revenue_per_minute", "currencyBRL", "series"),
    "Orders per Minute": ("orders_per_minute", "short", "series"),
    "Payment Success Rate": ("payment_success_rate", "percentunit", "series"),
    "Event Throughput by Type": ("events_per_minute", "short", "series_by_type"),
    "Active Users (Latest)": ("active_users_per_minute", "short", "latest"),
    "Low Stock Signals (Latest)": ("low_stock_signals_per_minute", "short", "latest"),
}
#: What a dashboard shows where nobody asks for another range.
DEFAULT_RANGE = timedelta(minutes=30)


def recent(last: timedelta = DEFAULT_RANGE, now: datetime | None = None) -> tuple[datetime, datetime]:
    """Bounds of a relative range: the last half hour, or another time, up to now. For the queries below and the table's reader."""
    if last <= timedelta(0):
        raise ValueError("a relative range has to reach back")
    end = now or datetime.now(timezone.utc)
    return end - last, end


def metric_series(
    metrics: DataFrame, name: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """(time, value) of one metric in time order."""
    return (
        between_instants(metrics.filter(F.col("metric_name") == name), start, end)
        .select(F.col("window_start").alias("time"), F.col("metric_value").alias("value"))
        .orderBy("time")
    )


def throughput_series(metrics: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """(time, metric, value): one series per event type."""
    by_type = (F.col("metric_name") == "events_per_minute") & (F.col("dimension_key") == "event_type")
    return (
        between_instants(metrics.filter(by_type), start, end)
        .select(
            F.col("window_start").alias("time"),
            F.col("dimension_value").alias("metric"),
            F.col("metric_value").alias("value"),
        )
        .orderBy("time")
    )


def throughput_table(
    metrics: DataFrame, event_types: Sequence[str], start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """The same with a column per given event type."""
    series = throughput_series(metrics, start, end)
    return series.groupBy("time").pivot("metric", list(event_types)).agg(F.sum("value")).orderBy("time")


def latest_metric(
    metrics: DataFrame, name: str | None = None, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """The newest value of every series, or of one metric's."""
    if name is not None:
        metrics = metrics.filter(F.col("metric_name") == name)
    return (
        between_instants(metrics, start, end)
        .groupBy("metric_name", "dimension_key", "dimension_value")
        .agg(
            F.max("window_start").alias("time"),
            F.max_by("metric_value", "window_start").alias("value"),
        )
    )


def panel(metrics: DataFrame, title: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Rows behind one panel of the dashboard."""
    name, _, form = PANELS[title]
    if form == "series_by_type":
        return throughput_series(metrics, start, end)
    if form == "latest":
        return latest_metric(metrics, name, start, end)
    return metric_series(metrics, name, start, end)
