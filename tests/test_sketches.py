"""Stored window sketches and what is rolled up from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from builders import event, events
from pulse.config import JobConfig
from pulse.operators.sketches import active_users, lag_quantiles, roll_up, users_error, window_sketches, within_errors
from pulse.sinks.sketch_table import read_sketch_table, write_sketch_table


def made(spark, n_users=20_000, minutes=120):
    """Every user in several minutes, lags of 0 to 99 seconds."""
    moment = F.timestamp_seconds(F.lit(1_772_900_000 - 1_772_900_000 % 3600) + F.col("id") % minutes * 60)
    return spark.range(n_users * 3).select(
        moment.alias("event_ts"), F.concat(F.lit("u"), F.col("id") % n_users).alias("user_id"),
        (moment + F.make_dt_interval(secs=F.col("id") % 100)).alias("producer_ts"))


def users(sketches):
    return {r[0]: r[1] for r in sketches.select("window_start", active_users(F.col("users_sketch"))).collect()}


def test_longer_windows_follow_from_minutes(spark):
    given = made(spark)
    minutes = window_sketches(given)
    for duration, slide in (("5 minutes", "1 minute"), ("1 hour", None), ("1 day", None)):
        direct = window_sketches(given, JobConfig(window_duration=duration, slide_duration=slide or duration))
        assert users(roll_up(minutes, duration, slide)) == users(direct)
    assert users(roll_up(roll_up(minutes, "10 minutes"), "1 day")) == users(roll_up(minutes, "1 day"))
    day = roll_up(minutes, "1 day").select(active_users(F.col("users_sketch")).alias("n"), "n_events", lag_quantiles(F.col("lag_sketch")).alias("q"))
    row = day.withColumn("near", within_errors(F.col("n"), F.lit(20_000), users_error())).first()
    assert row["near"] and row["n_events"] == 60_000
    assert all(abs(found - asked) <= 2.5 for found, asked in zip(row["q"], (49, 94, 98)))


def test_parts_of_a_window_merge_in_any_order(spark):
    given = made(spark, 3_000, 10)
    parts = [window_sketches(given.filter(F.xxhash64("user_id", "event_ts") % 3 == i)) for i in range(-2, 3)]
    together, backwards = parts[0], parts[-1]
    for a, b in zip(parts[1:], parts[-2::-1]):
        together, backwards = together.unionByName(a), backwards.unionByName(b)
    assert users(roll_up(together, "1 hour")) == users(roll_up(backwards, "1 hour")) == users(window_sketches(given, JobConfig(
        window_duration="1 hour", slide_duration="1 hour")))


def test_rolling_up_reads_no_events(spark, tmp_path):
    write_sketch_table(window_sketches(made(spark, 100)), str(tmp_path / "t"))
    rolled = roll_up(read_sketch_table(spark, str(tmp_path / "t"), datetime(2026, 3, 7), datetime(2026, 3, 8)), "1 hour")
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "user_id" not in plan and "window_date" in plan.split("PartitionFilters")[1]


def test_later_runs_replace_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    write_sketch_table(window_sketches(made(spark, 100, 2)), path, run_id="a")
    write_sketch_table(window_sketches(made(spark, 900, 2)), path, run_id="b")
    found = users(read_sketch_table(spark, path))
    assert len(found) == 2 and all(450 - 20 <= n <= 900 for n in found.values())
    write_sketch_table(window_sketches(made(spark, 0)), path, run_id="c")
    assert users(read_sketch_table(spark, path)) == found
    assert roll_up(window_sketches(made(spark, 0)), "1 day").count() == 0


def test_missing_users_and_producer_times(spark):
    given = events(spark, event(at="2026-03-07T18:00:10Z", without=("user_id", "producer_time")),
                   event(at="2026-03-07T18:00:20Z", user_id=None), event(at="2026-03-07T18:00:30Z", user_id="a"))
    row = window_sketches(given).select("*", active_users(F.col("users_sketch")).alias("n")).first()
    assert (row["n"], row["n_events"]) == (1, 3)
    nobody = window_sketches(events(spark, event(user_id=None, producer_time=None)))
    assert nobody.select(active_users(F.col("users_sketch"))).first()[0] == 0
    assert roll_up(nobody, "1 day").select(active_users(F.col("users_sketch"))).first()[0] == 0
