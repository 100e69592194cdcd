"""Producer lag, event mix, duplicates and topic routing."""

from __future__ import annotations

from collections.abc import Mapping
from math import pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.contract import DOMAIN_TOPICS, EXPECTED_MIX
from pulse.functions.columns import event_identity


def producer_lag(events: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Seconds between event time and producer time, per window."""
    lag = (F.unix_micros("producer_ts") - F.unix_micros("event_ts")) / 1_000_000
    return (
        events.filter(F.col("producer_ts").isNotNull())
        .groupBy(F.window("event_ts", config.window_duration, config.slide_duration).alias("window"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.avg(lag).alias("avg_lag"),
            F.max(lag).alias("max_lag"),
            F.percentile_approx(lag, [0.5, 0.95, 0.99]).alias("quantiles"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "n_events",
            "avg_lag",
            "max_lag",
            *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("p50_lag", "p95_lag", "p99_lag"))],
        )
    )


def event_mix(events: DataFrame, expected: Mapping[str, float] = EXPECTED_MIX) -> DataFrame:
    """Share of each expected event type, and of all other types together as ``unknown``.

    One aggregation to one row of counts, so types that should not exist cannot
    inflate the result.
    """
    names = [*expected, "unknown"]
    known = F.coalesce(F.col("event_type").isin(*expected), F.lit(False))
    counts = [F.count_if(F.col("event_type") == name).alias(name) for name in expected]
    total = events.agg(F.count(F.lit(1)).alias("total"), *counts, F.count_if(~known).alias("unknown"))
    rows = [
        F.struct(
            F.lit(name).alias("event_type"),
            F.col(name).alias("n_events"),
            F.try_divide(F.col(name).cast("double"), F.col("total")).alias("share"),
            F.lit(float(expected.get(name, 0.0))).alias("expected_share"),
        )
        for name in names
    ]
    return total.select(F.inline(F.array(*rows))).withColumn(
        "deviation", F.col("share") - F.col("expected_share")
    )


def chi_square_tail(value: Column, freedom: int) -> Column:
    """Probability that a chi-square variable of so many degrees of freedom exceeds the value, to a part in 10^7."""
    half = value / 2
    terms, term = F.lit(0.0), F.lit(1.0)
    if freedom % 2 == 0:
        for i in range(freedom // 2):
            terms = terms + term
            term = term * half / (i + 1)
        return F.exp(-half) * terms
    # Odd: the normal tail by a rational Chebyshev fit, then one term for every further two degrees.
    root = F.sqrt(half)
    t = 1 / (1 + root / 2)
    fit = F.lit(0.0)
    for c in reversed(_NORMAL_TAIL):
        fit = fit * t + c
    tail = t * F.exp(-half + fit)
    term = F.exp(-half) * root * 2 / sqrt(pi)
    for i in range(1, (freedom + 1) // 2):
        tail = tail + term
        term = term * half / (i + 0.5)
    return tail


#: Coefficients of the published Chebyshev fit of the complementary error function, relative error 1.2e-7.
_NORMAL_TAIL = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def mix_drift(
    events: DataFrame, config: JobConfig = JobConfig(), expected: Mapping[str, float] = EXPECTED_MIX, level: float = 0.01,
) -> DataFrame:
    """Windows whose mix of event types departs from the expected weights: a G-test each, corrected for their number.

    Events of other types are counted apart and not tested. The level is that of any false alarm among all windows
    (Bonferroni), so a long table does not raise more of them than a short one. One aggregation makes a row of counts
    per window; weights need not add up to 1.
    """
    if len(expected) < 2 or min(expected.values()) <= 0:
        raise ValueError("two or more types with positive weights are wanted")
    known = F.coalesce(F.col("event_type").isin(*expected), F.lit(False))
    names = {name: f"n_{i}" for i, name in enumerate(expected)}
    counts = events.groupBy(F.window("event_ts", config.window_duration, config.slide_duration).alias("window")).agg(
        *(F.count_if(F.col("event_type") == name).alias(column) for name, column in names.items()),
        F.count_if(known).alias("n_events"), F.count_if(~known).alias("n_unknown"))
    total, weights = F.col("n_events"), sum(expected.values())
    surprise = F.lit(0.0)
    for name, column in names.items():
        share = F.col(column) / (total * (expected[name] / weights))
        surprise = surprise + F.when(F.col(column) > 0, F.col(column) * F.ln(share)).otherwise(0.0)
    tested = counts.withColumn("g", F.when(total > 0, F.greatest(F.lit(0.0), 2 * surprise)))
    judged = tested.withColumn("p_value", chi_square_tail(F.col("g"), len(expected) - 1))
    windows = judged.agg(F.count("g").alias("n_windows"))  # one row
    return judged.join(F.broadcast(windows)).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_events", "n_unknown", "g", "p_value",
        F.coalesce(F.col("p_value") * F.col("n_windows") < level, F.lit(False)).alias("drifted"))


def dedup_events(events: DataFrame, always_placed: bool = False) -> DataFrame:
    """One row per event id: the first by broker time and place. Records without id or place all stay.

    On a stream, ids are remembered for the watermark delay and the first to arrive stays. A batch
    aggregates map-side first, so a heavily repeated id is one row per task in the
    shuffle. ``always_placed`` says that every record has a broker place, as from Kafka, and
    spares the second read for records without any.
    """
    keyed = events.withColumn("__identity", event_identity())
    known = keyed.filter(F.col("__identity").isNotNull())
    if events.isStreaming:
        once = known.dropDuplicatesWithinWatermark(["__identity"]).drop("__identity")
    else:
        order = F.struct("kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset")
        first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in events.columns]), order).alias("first")
        once = known.groupBy("__identity").agg(first).select("first.*")
    if always_placed:
        return once
    return once.unionByName(keyed.filter(F.col("__identity").isNull()).drop("__identity"))


def route_topics(
    events: DataFrame, topics: Mapping[str, str] = DOMAIN_TOPICS, default: str = "events.raw"
) -> DataFrame:
    """A ``topic`` column by business domain, for the Kafka sink."""
    pairs = [F.lit(x) for pair in topics.items() for x in pair]
    topic = F.try_element_at(F.create_map(*pairs), F.col("event_type"))
    return events.withColumn("topic", F.coalesce(topic, F.lit(default)))
