"""Alert episodes and drift of the event mix."""

from __future__ import annotations

from datetime import datetime, timedelta
from math import erfc, exp, gamma, sqrt

import pytest
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.contract import METRIC_SCHEMA
from pulse.operators.monitor import chi_square_tail, mix_drift
from pulse.plans.insights import alert_episodes, alerts, thresholds

MIDNIGHT = datetime(2026, 3, 8)
RULES = [("rate", 0.5, None, "critical"), ("rate", 0.2, None, "page"), ("load", None, 10.0, "info")]


def metrics(spark, rows):
    made = [((MIDNIGHT + timedelta(minutes=m)).isoformat(), name, value, dimension) for m, name, value, dimension in rows]
    start = F.to_timestamp("at")
    return spark.createDataFrame(made, "at string, metric_name string, metric_value double, dimension_value string").select(
        start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"), "metric_name", "metric_value",
        F.lit("scope").alias("dimension_key"), "dimension_value", F.current_timestamp().alias("processed_at"))


def found(episodes):
    at = [F.date_format(c, "dd HH:mm").alias(c) for c in ("opened", "closed")]
    return {(r["metric_name"], r["dimension_value"], r["severity"], r["opened"], r["closed"], r["n_windows"], r["worst_value"])
            for r in episodes.select("metric_name", "dimension_value", "severity", *at, "n_windows", "worst_value").collect()}


# One across midnight, a second level within it, a pause, another series, one without a name.
ROWS = [(-2, "rate", 0.4, "all"), (-1, "rate", 0.1, "all"), (0, "rate", 0.3, "all"), (1, "rate", 0.9, "all"), (2, "rate", 0.45, "all"),
        (0, "load", 11.0, "a"), (1, "load", 15.0, "a"), (1, "load", 12.0, "b"), (5, "load", 99.0, None), (6, "load", 98.0, None), (6, "other", 0.0, "all")]
EPISODES = {("rate", "all", "critical", "07 23:58", "08 00:01", 3, 0.1), ("rate", "all", "critical", "08 00:02", "08 00:03", 1, 0.45),
            ("rate", "all", "page", "07 23:59", "08 00:00", 1, 0.1), ("load", "a", "info", "08 00:00", "08 00:02", 2, 15.0),
            ("load", "b", "info", "08 00:01", "08 00:02", 1, 12.0), ("load", None, "info", "08 00:05", "08 00:07", 2, 99.0)}


def test_episodes_by_hand(spark):
    breaches = alerts(metrics(spark, ROWS), thresholds(spark, RULES))
    assert found(alert_episodes(breaches)) == EPISODES
    forgiving = {e for e in EPISODES if e[2] != "critical"} | {("rate", "all", "critical", "07 23:58", "08 00:03", 4, 0.1)}
    assert found(alert_episodes(breaches, "2 minutes")) == forgiving
    assert alert_episodes(alerts(metrics(spark, []), thresholds(spark, RULES))).count() == 0


def test_episodes_on_a_stream_come_out_when_they_are_over(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(METRIC_SCHEMA).parquet(source).withWatermark("window_start", "1 minute")
    episodes = alert_episodes(alerts(stream, thresholds(spark, RULES)))
    for rows in (ROWS[:2], ROWS[2:], [(60, "rate", 0.0, "all")]):
        metrics(spark, rows).coalesce(1).write.mode("append").parquet(source)
        (episodes.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start().awaitTermination())
    assert found(spark.read.parquet(out)) == EPISODES


def tail(value, freedom):
    half = value / 2
    if freedom % 2 == 0:
        return exp(-half) * sum(half**i / gamma(i + 1) for i in range(freedom // 2))
    return erfc(sqrt(half)) + exp(-half) * sum(half ** (i - 0.5) / gamma(i + 0.5) for i in range(1, (freedom + 1) // 2))


@pytest.mark.parametrize("freedom", [1, 2, 3, 4, 5, 8, 11])
def test_chi_square_tail(spark, freedom):
    values = [0.0, 0.1, 1.0, 3.84, 9.49, 20.0, 60.0]
    given = spark.createDataFrame([(v,) for v in values], "v double")
    rows = {r[0]: r[1] for r in given.select("v", chi_square_tail(F.col("v"), freedom)).collect()}
    assert all(rows[v] == pytest.approx(tail(v, freedom), rel=2e-6, abs=1e-14) for v in values)
    assert tail(3.841459, 1) == pytest.approx(0.05, rel=1e-5) and tail(9.487729, 4) == pytest.approx(0.05, rel=1e-5)


def test_planted_shift_is_found_and_other_windows_are_quiet(spark):
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    draw = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    kind = F.when(draw < 0.5, "a").when(draw < 0.8, "b").otherwise("c")
    hour = F.floor(F.col("id") / 1000)
    events = spark.range(100_000).select(
        F.timestamp_seconds(F.lit(1_772_841_600) + hour * 3600).alias("event_ts"),
        F.when((hour == 40) & (F.col("id") % 6 == 0), "c").when(F.col("id") % 500 == 3, "new").when(F.col("id") % 500 == 4, None)
        .otherwise(kind).alias("event_type"))
    config = JobConfig(window_duration="1 hour", slide_duration="1 hour")
    rows = mix_drift(events, config, weights).orderBy("window_start").collect()
    assert [i for i, r in enumerate(rows) if r["drifted"]] == [40]
    assert all(r["n_events"] + r["n_unknown"] == 1000 for r in rows) and rows[0]["n_unknown"] == 4
    assert mix_drift(events, config, {k: 7 * v for k, v in weights.items()}).filter("drifted").count() == 1


def test_windows_without_known_types_and_bad_weights(spark):
    one = spark.sql("SELECT timestamp'2026-03-08 00:00:00Z' AS event_ts, 'new' AS event_type")
    row = mix_drift(one, expected={"a": 1.0, "b": 1.0}).first()
    assert (row["n_events"], row["n_unknown"], row["g"], row["p_value"], row["drifted"]) == (0, 1, None, None, False)
    assert mix_drift(one.limit(0), expected={"a": 1.0, "b": 1.0}).count() == 0
    for weights in ({"a": 1.0}, {"a": 1.0, "b": 0.0}):
        with pytest.raises(ValueError):
            mix_drift(one, expected=weights)
