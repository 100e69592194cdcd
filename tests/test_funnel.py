"""The funnel against a plain walk through each user's events, in a batch and on a stream."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.plans.insights import funnel

TYPES = ("page_view", "add_to_cart", "order_created", "payment_processed", None)
START = datetime(2026, 3, 7, 18)


def made(seed, n=1500, users=40, minutes=50, seconds=60):
    rng = random.Random(seed)
    return [(rng.choice(TYPES), rng.choice([None, *map(str, range(users))]),
             START + timedelta(seconds=rng.randrange(minutes * 60) // seconds * seconds, microseconds=rng.choice((0, 1, 999_999)))) for _ in range(n)]


def walked(rows, length, slide):
    counts, seen = {}, {}
    for kind, user, at in rows:
        if kind in TYPES[:3] and user is not None:
            epoch = (at - datetime(1970, 1, 1)).total_seconds()
            start = epoch // slide * slide
            while start + length > epoch:
                seen.setdefault((start, user), []).append((at, TYPES.index(kind)))
                start -= slide
    for (start, _), moves in seen.items():
        reached = 0
        for _, step in sorted(moves):
            reached += step == reached
        row = counts.setdefault(datetime(1970, 1, 1) + timedelta(seconds=start), [0, 0, 0])
        for i in range(3):
            row[i] += reached > i
    return counts


def table(spark, rows):
    given = spark.createDataFrame([(k, u, at.isoformat()) for k, u, at in rows], "event_type string, user_id string, at string")
    return given.select("event_type", "user_id", F.to_timestamp("at").alias("event_ts"))


def found(counted):
    start = F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss")
    return {datetime.fromisoformat(r[0]): [r[1], r[2], r[3]] for r in counted.select(start, "viewers", "carters", "buyers").collect()}


@pytest.mark.parametrize("seed, length, slide, seconds", [(1, 60, 60, 1), (2, 600, 600, 60), (3, 300, 60, 20), (4, 86400, 86400, 1)])
def test_steps_are_taken_in_turn(spark, seed, length, slide, seconds):
    rows = made(seed, seconds=seconds)
    config = JobConfig(window_duration=f"{length} seconds", slide_duration=f"{slide} seconds")
    assert found(funnel(table(spark, rows), config)) == walked(rows, length, slide)


def test_a_very_active_user_and_empty_input(spark):
    rows = [(TYPES[i * 7 % 3], "hot", START + timedelta(milliseconds=250 * i)) for i in range(4000)]
    rows += [("add_to_cart", "x", START), ("page_view", "x", START), ("order_created", "y", START)]
    config = JobConfig(window_duration="1 hour", slide_duration="1 hour")
    assert found(funnel(table(spark, rows), config)) == walked(rows, 3600, 3600)
    assert funnel(table(spark, []), config).count() == 0


def test_one_scan_and_one_exchange_of_events(spark, tmp_path):
    table(spark, made(1, 50)).write.parquet(str(tmp_path / "events"))
    plan = funnel(spark.read.parquet(str(tmp_path / "events")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Join") == 0
    assert sum("slice" in line and "hashpartitioning" in line for line in plan.splitlines()) == 1


def test_the_stream_gives_the_batch_rows_of_closed_windows(spark, tmp_path):
    rows = made(9, 900, users=8)
    config = JobConfig(window_duration="10 minutes", slide_duration="10 minutes")
    ordered = sorted(rows, key=lambda r: r[2].minute // 10 + random.Random(str(r)).random() * 0.1)
    source = str(tmp_path / "in")
    for i in range(0, 900, 300):
        table(spark, ordered[i : i + 300]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("event_type string, user_id string, event_ts timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    (funnel(stream.withWatermark("event_ts", "20 minutes"), config).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination())
    batch = walked(rows, 600, 600)
    closed = found(spark.read.parquet(out))
    assert len(closed) >= 2 and closed == {start: batch[start] for start in closed}
