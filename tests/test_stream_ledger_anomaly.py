"""Identities beyond the watermark, and anomaly scores on a stream."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from builders import event
from pulse.contract import METRIC_SCHEMA
from pulse.operators.normalize import normalize_events
from pulse.operators.parse import parse_events
from pulse.plans.insights import anomaly_scores
from pulse.streaming.anomaly import anomaly_score_stream
from pulse.streaming.ledger import UNJUDGED, forget, ledger_writer, unique_events
from test_streaming import Replay, replay  # noqa: F401

COLUMNS = ("event_id", "event_ts", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp")


class Deduplicated:
    def __init__(self, replay, retention_days=35):  # noqa: F811
        self.replay, self.path = replay, str(replay.root / "unique")
        self.writer = ledger_writer(self.path, retention_days)
        self.events = normalize_events(parse_events(replay.source())).select(*COLUMNS)

    def step(self, *bodies, writer=None):
        if bodies:
            self.replay.add_events(*bodies)
        (self.events.writeStream.option("checkpointLocation", str(self.replay.root / "ledger-checkpoint"))
         .trigger(availableNow=True).foreachBatch(writer or self.writer).start().awaitTermination())
        return self.read()

    def read(self, *verdict):
        return sorted(r[0] or "" for r in unique_events(self.replay.spark, self.path, self.events.schema, *verdict).select("event_id").collect())


def on(day, second=0, **changes):
    return event(at=f"2026-03-{day:02d}T12:00:{second:02d}Z", **changes)


def test_a_copy_a_week_late_is_dropped_and_a_restart_loses_nothing(replay: Replay):  # noqa: F811
    kept, failures = Deduplicated(replay), []

    def fails_once(batch, batch_id):
        kept.writer(batch, batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("executor host lost")

    assert kept.step(on(1, event_id="a"), on(1, event_id="a"), on(1, event_id="b")) == ["a", "b"]
    with pytest.raises(Exception, match="executor host lost"):
        kept.step(on(8, event_id="c"), on(1, event_id="a"), writer=fails_once)
    assert kept.step() == ["a", "b", "c"]  # the batch that failed after its write is judged again, and alike
    assert kept.step(on(8, event_id="c"), on(1, event_id="b"), on(9, event_id="d"), on(9, event_id="d")) == ["a", "b", "c", "d"]
    # The same id with another time is another day's: not a copy of that event.
    assert kept.step(on(10, event_id="a")) == ["a", "a", "b", "c", "d"]


def test_forgotten_days_are_set_aside_and_files_put_together(replay: Replay):  # noqa: F811
    kept, spark = Deduplicated(replay, retention_days=5), replay.spark
    for number in range(3):
        assert kept.step(on(1, number, event_id=f"x{number}"), on(2, number, event_id=f"y{number}"))
    ledger = f"{kept.path}/ledger"
    forget(spark, kept.path, date(2026, 3, 2), date(2026, 3, 3))
    assert sorted(f for f in os.listdir(ledger) if "=" in f) == ["event_day=2026-03-02"]
    assert os.listdir(f"{ledger}/event_day=2026-03-02") == ["batch_id=-1"]
    assert spark.read.parquet(ledger).count() == 3
    before = kept.read()
    assert kept.step(on(2, 1, event_id="y1"), on(2, 9, event_id="y9")) == sorted([*before, "y9"])
    forget(spark, kept.path, date(2026, 3, 2), date(2026, 3, 3))
    assert kept.step(on(2, 9, event_id="y9")) == sorted([*before, "y9"]) and spark.read.parquet(ledger).count() == 4


def test_old_and_nameless_events(spark, tmp_path):
    path = str(tmp_path / "unique")
    rows = spark.sql("""SELECT * FROM VALUES ('old', timestamp'2026-03-01 00:00:00Z', timestamp'2026-03-20 00:00:00Z'),
        ('new', timestamp'2026-03-19 00:00:00Z', timestamp'2026-03-20 00:00:00Z'), ('files', timestamp'2026-03-01 00:00:00Z', null),
        (null, timestamp'2026-03-19 00:00:00Z', null), (null, timestamp'2026-03-19 00:00:00Z', null) AS t(event_id, event_ts, kafka_timestamp)""")
    rows = rows.withColumns({"kafka_topic": F.lit(None).cast("string"), "kafka_partition": F.lit(None).cast("int"),
                             "kafka_offset": F.lit(None).cast("long")})
    write = ledger_writer(path, retention_days=7)
    write(rows, 0)
    write(rows, 1)
    new = [r["event_id"] for r in unique_events(spark, path, rows.schema).collect()]
    assert sorted(x or "" for x in new) == ["", "", "", "", "files", "new"]
    assert [r["event_id"] for r in unique_events(spark, path, rows.schema, UNJUDGED).collect()] == ["old", "old"]


def test_scores_on_a_stream_equal_the_batch_across_restarts(spark, replay: Replay):  # noqa: F811
    start = F.timestamp_seconds(F.lit(1_772_841_600) + F.col("id") * 60)
    rows = spark.range(240).filter("id % 60 < 45 OR id > 200").select(
        start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
        F.concat(F.lit("m"), F.col("id") % 2).alias("metric_name"),
        F.when(F.col("id") < 60, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100)).cast("double")).alias("metric_value"),
        F.lit("scope").alias("dimension_key"), F.when(F.col("id") % 3 == 0, "all").alias("dimension_value"), F.current_timestamp().alias("processed_at"))
    stream = anomaly_score_stream(spark.readStream.schema(METRIC_SCHEMA).parquet(str(replay.root / "in")), "20 minutes")
    out = str(replay.root / "out")
    for low in range(0, 240, 80):
        minute = (F.unix_seconds("window_start") - 1_772_841_600) / 60
        rows.filter((minute >= low) & (minute < low + 80)).repartition(1).write.mode("append").parquet(str(replay.root / "in"))
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(replay.root / "c"))
         .trigger(availableNow=True).start().awaitTermination())
    key = ("window_start", "metric_name", "dimension_value")

    def found(scored):
        measures = [F.round(F.col(c).cast("double"), 6) for c in ("metric_value", "n_history", "mean", "deviation", "z_score")]
        return {tuple(r) for r in scored.select(*key, *measures).collect()}

    expected = found(anomaly_scores(rows, "20 minutes"))
    assert found(spark.read.parquet(out)) == expected and len(expected) == rows.count()
