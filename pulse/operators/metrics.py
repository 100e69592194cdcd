"""All windowed metrics in one aggregation.

Each event is keyed once per dimension, one grouped aggregation computes every
measure, and the aggregated row is unfolded into long metric rows afterwards.
One scan, one shuffle and, on a stream, one stateful operator serve all metrics.
Map-side partial aggregation bounds what a busy window or type sends over the
network to one row per task and group.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.contract import METRIC_COLUMNS


@dataclass(frozen=True)
class Measure:
    """An aggregate over the events of one group, optionally of some event types only."""

    name: str
    aggregate: str
    event_type: str | None = None


@dataclass(frozen=True)
class Metric:
    """A metric row: which dimension it is cut by, its value, and when it exists.

    ``value`` and ``present`` are SQL over the measures' names.
    """

    name: str
    dimension: str
    measures: tuple[Measure, ...]
    value: str
    present: str = "true"


# Dimension key -> SQL of its value for an event.
DIMENSIONS = {"event_type": "event_type", "scope": "'all'"}

N_EVENTS = Measure("n_events", "count(1)")
N_ORDERS = Measure("n_orders", "count(1)", "order_created")
REVENUE = Measure("revenue", "sum(total_amount)", "order_created")
N_ATTEMPTS = Measure("n_attempts", "count(1)", "payment_processed")
N_APPROVED = Measure("n_approved", "count_if(payment_status = 'approved')", "payment_processed")
USERS = Measure("users", "approx_count_distinct(user_id)")
USERS_EXACT = Measure("users", "count(DISTINCT user_id)")
N_STOCK = Measure("n_stock", "count(1)", "inventory_updated")
LOW_STOCK = Measure("low_stock", "sum(low_stock_flag)", "inventory_updated")

METRICS = (
    Metric("events_per_minute", "event_type", (N_EVENTS,), "n_events"),
    Metric("revenue_per_minute", "scope", (N_ORDERS, REVENUE), "revenue", "n_orders > 0"),
    Metric("orders_per_minute", "scope", (N_ORDERS,), "n_orders", "n_orders > 0"),
    Metric("payment_success_rate", "scope", (N_ATTEMPTS, N_APPROVED), "try_divide(n_approved, n_attempts)",
           "n_attempts > 0"),
    Metric("active_users_per_minute", "scope", (USERS,), "users"),
    Metric("low_stock_signals_per_minute", "scope", (N_STOCK, LOW_STOCK), "low_stock", "n_stock > 0"),
)

# Distinct users counted exactly: batch only, Spark has no streaming form of it.
ACTIVE_USERS_EXACT = Metric("active_users_per_minute", "scope", (USERS_EXACT,), "users")
METRICS_EXACT = tuple(ACTIVE_USERS_EXACT if m.name == ACTIVE_USERS_EXACT.name else m for m in METRICS)


def named(*names: str, among: Sequence[Metric] = METRICS) -> tuple[Metric, ...]:
    known = {m.name: m for m in among}
    return tuple(known[name] for name in names)


def build_metrics(
    events: DataFrame, config: JobConfig = JobConfig(), metrics: Sequence[Metric] = METRICS
) -> DataFrame:
    """Normalised events to metric rows (`contract.METRIC_COLUMNS`).

    Values are per window: with another duration than a minute they are not rescaled.
    """
    return unfold_metrics(window_measures(events, config, metrics), metrics)


def window_measures(events: DataFrame, config: JobConfig, metrics: Sequence[Metric]) -> DataFrame:
    """One row per window and dimension value with every measure the metrics need."""
    dimensions = [d for d in DIMENSIONS if any(m.dimension == d for m in metrics)]
    users: dict[Measure, set[str]] = {}
    for metric in metrics:
        for measure in metric.measures:
            users.setdefault(measure, set()).add(metric.dimension)

    types = {measure.event_type for measure in users}
    if None not in types:
        # No metric looks at the other events, so they need not reach the aggregation.
        events = events.filter(F.col("event_type").isin(sorted(types)))

    keys = ", ".join(f"struct('{d}' AS dimension_key, {DIMENSIONS[d]} AS dimension_value)" for d in dimensions)
    keyed = events.select("*", F.inline(F.expr(f"array({keys})")))
    if USERS_EXACT in users and _folds(config) and all(m == USERS_EXACT or MERGED_BY_SUM.match(m.aggregate) for m in users):
        return _pane_measures(keyed, config, users, dimensions)
    window = F.window("event_ts", config.window_duration, config.slide_duration).alias("window")
    return keyed.groupBy(window, "dimension_key", "dimension_value").agg(
        *[_aggregate(measure, needed, dimensions) for measure, needed in users.items()]
    )


# Aggregates whose value over several panes is the sum of the panes' values.
MERGED_BY_SUM = re.compile(r"(count|count_if|sum)\((?!\s*distinct)[^()]*\)$", re.IGNORECASE)
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _folds(config: JobConfig) -> bool:
    """Whether windows overlap and each is made of whole slides."""
    spans = []
    for text in (config.window_duration, config.slide_duration):
        found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", text, re.IGNORECASE)
        if not found:
            return False
        spans.append(int(found[1]) * SECONDS[found[2].lower()])
    duration, slide = spans
    return slide > 0 and duration > slide and duration % slide == 0


def _pane_measures(keyed: DataFrame, config: JobConfig, users: dict[Measure, set[str]], dimensions: Sequence[str]) -> DataFrame:
    """Measures of overlapping windows from panes of one slide, users counted exactly.

    A distinct count over the windows would hold every event once per window and dimension. Here an event is
    held once, with its pane and user. A user counts in the windows of a pane that do not reach back to
    that user's pane before, so the windows themselves only add up.
    """
    sums = [measure for measure in users if measure != USERS_EXACT]
    counted = F.col("dimension_key").isin(sorted(users[USERS_EXACT]))
    pane = F.window("event_ts", config.slide_duration).start.alias("pane")
    panes = keyed.groupBy(pane, "dimension_key", "dimension_value", F.when(counted, F.col("user_id")).alias("user")).agg(
        *[_aggregate(measure, users[measure], dimensions) for measure in sums]
    )
    of_user = Window.partitionBy("dimension_key", "dimension_value", "user").orderBy("pane")
    window = F.window("pane", config.window_duration, config.slide_duration).alias("window")
    placed = panes.withColumn("before", F.lag("pane").over(of_user)).select("*", window)
    first = F.col("user").isNotNull() & (F.col("before").isNull() | (F.col("before") < F.col("window.start")))
    return placed.groupBy("window", "dimension_key", "dimension_value").agg(
        *[F.sum(measure.name).alias(measure.name) for measure in sums], F.count_if(first).alias(USERS_EXACT.name)
    )


def _aggregate(measure: Measure, needed: set[str], dimensions: Sequence[str]):
    conditions = []
    if needed != set(dimensions):
        conditions.append("dimension_key IN ({})".format(", ".join(f"'{d}'" for d in sorted(needed))))
    if measure.event_type is not None:
        conditions.append(f"event_type = '{measure.event_type}'")
    where = f" FILTER (WHERE {' AND '.join(conditions)})" if conditions else ""
    return F.expr(measure.aggregate + where).alias(measure.name)


def unfold_metrics(measures: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Wide aggregated rows to long metric rows; a metric without data gives no row."""
    rows = ", ".join(
        f"struct('{m.name}' AS metric_name, coalesce(CAST({m.value} AS DOUBLE), 0D) AS metric_value,"
        f" coalesce(dimension_key = '{m.dimension}' AND {m.present}, false) AS present)"
        for m in metrics
    )
    return (
        measures.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "dimension_key",
            "dimension_value",
            F.inline(F.expr(f"array({rows})")),
        )
        .filter("present")
        .select(*METRIC_COLUMNS[:-1], F.current_timestamp().alias(METRIC_COLUMNS[-1]))
    )
