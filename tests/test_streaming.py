from __future__ import annotations

import os
import subprocess
import sys
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from builders import event, records, values
from conftest import SMALL_DIR
from pulse.config import JobConfig
from pulse.contract import RECORD_SCHEMA
from pulse.operators.metrics import build_metrics, named
from pulse.operators.monitor import dedup_events
from pulse.operators.normalize import normalize_events
from pulse.operators.parse import parse_events, with_broker_columns
from pulse.plans.pipeline import metrics_from_records
from pulse.sinks.metric_table import metric_batch_writer, read_metric_table
from pulse.sources.records import read_records
from pulse.streaming import job
from pulse.streaming.paths import checkpoint_location, shared_root
from pulse.streaming.reconcile import dealt, reconcile_payment_stream
from testkit.adapter import event_records, read_events


@pytest.fixture
def replay(spark, tmp_path):
    """A record folder, a job over it, and its table."""
    for key, value in JobConfig().session_conf().items():
        spark.conf.set(key, value)
    return Replay(spark, tmp_path)


class Replay:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.config = JobConfig(app_name=root.name, checkpoint_dir=str(root / "checkpoint"))
        self.table = str(root / "table")
        (root / "in").mkdir()

    def add(self, raw):
        columns = [F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA]
        with_broker_columns(raw).select(columns).coalesce(1).write.mode("append").parquet(str(self.root / "in"))

    def add_events(self, *bodies):
        self.add(records(self.spark, *bodies))

    def source(self, **options):
        return read_records(self.spark, str(self.root / "in"), streaming=True, **options)

    def run(self, writer=None, config=None, **options):
        query = job.start_metrics(self.source(**options), config or self.config,
                                  writer or metric_batch_writer(self.table), available_now=True)
        query.awaitTermination()
        return query

    def rows(self):
        return read_metric_table(self.spark, self.table)


def at(minute, second=0):
    return f"2026-03-07T18:{minute:02d}:{second:02d}Z"


def dropped(query):
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def test_stream_equals_batch_on_closed_windows_in_one_operator(spark, replay):
    raw = event_records(read_events(spark, SMALL_DIR)).cache()
    for part in range(3):
        replay.add(raw.filter(F.floor(F.col("offset") / 334) == part))
    query = replay.run(max_files_per_trigger=1)
    batch = metrics_from_records(raw)
    last = batch.agg(F.max("window_end")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 10 MINUTES")).drop("processed_at")
    streamed = replay.rows().drop("processed_at", "window_date")
    assert closed.exceptAll(streamed).count() == 0
    assert streamed.exceptAll(batch.drop("processed_at")).count() == 0
    progress = query.recentProgress
    assert max(len(p["stateOperators"]) for p in progress) == 1
    assert sum(p["numInputRows"] for p in progress) == raw.count()
    assert query.name == replay.config.query_name
    raw.unpersist()


def test_plan_has_one_scan_one_decode_one_aggregation(replay):
    replay.add_events(event(at=at(0)), event(at=at(9)))
    plan = replay.run()._jsq.explainInternal(False)
    assert plan.count("from_json") == 1 and plan.count("StateStoreSave") == 1 and plan.count("MicroBatchScan") <= 1


def test_filters_do_not_repeat_the_decode(spark):
    plain = normalize_events(parse_events(records(spark, event()))).filter("event_type = 'order_created' AND amount > 0")
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_late_events_are_dropped_and_counted(replay):
    replay.add_events(event(at=at(0, 10)), event(at=at(0, 50)), event(at=at(1)))
    replay.run()
    assert replay.rows().count() == 0
    replay.add_events(event(at=at(5)))
    replay.run()
    replay.add_events(event(at=at(0, 20)), event(at=at(4, 30)))
    assert dropped(replay.run()) > 0
    replay.add_events(event(at=at(9)))
    replay.run()
    found = values(replay.rows(), "events_per_minute")
    assert found == {("18:00", "page_view"): 2.0, ("18:01", "page_view"): 1.0, ("18:04", "page_view"): 1.0,
                     ("18:05", "page_view"): 1.0}


def test_restart_after_a_failure_loses_and_repeats_nothing(spark, replay):
    write, failures = metric_batch_writer(replay.table), []

    def fails_after_its_second_write(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("executor host lost")

    for minute in (0, 5, 10, 15):
        replay.add_events(event(at=at(minute)), event(at=at(minute, 30)))
        if minute == 5:
            with pytest.raises(Exception, match="executor host lost"):
                replay.run(fails_after_its_second_write, max_files_per_trigger=1)
        elif minute > 5:
            replay.run(fails_after_its_second_write, max_files_per_trigger=1)
    assert failures == [1]
    rows = [tuple(r) for r in replay.rows().filter("metric_name = 'events_per_minute'").collect()]
    assert len(rows) == 3 and sum(r[3] for r in rows) == 6.0


def test_a_new_checkpoint_does_not_overwrite_the_old_run(replay):
    replay.add_events(event(at=at(0)), event(at=at(9)))
    replay.run()
    replay.run(config=JobConfig(app_name="second", checkpoint_dir=str(replay.root / "other")))
    assert values(replay.rows(), "events_per_minute") == {("18:00", "page_view"): 1.0}
    every = read_metric_table(replay.spark, replay.table, every_version=True)
    assert every.filter("metric_name = 'events_per_minute'").count() == 2
    assert replay.rows().filter("metric_name = 'events_per_minute'").count() == 1


def test_stream_dedup_across_batches(spark, replay):
    rows = dedup_events(normalize_events(parse_events(replay.source())))
    counted = build_metrics(rows, replay.config, named("events_per_minute"))
    for bodies in ([event(at=at(0))], [event(at=at(0)), event(at=at(0, 1), event_id="evt_2")], [event(at=at(9), event_id="x")]):
        replay.add_events(*bodies)
        (counted.writeStream.option("checkpointLocation", str(replay.root / "c")).outputMode("append")
         .trigger(availableNow=True).foreachBatch(metric_batch_writer(replay.table)).start().awaitTermination())
    assert values(replay.rows(), "events_per_minute") == {("18:00", "page_view"): 2.0}


def test_stream_reconciliation(spark, replay):
    def order(order_id, when):
        return event("order_created", when, {"order_id": order_id}, event_id=f"o{order_id}")

    def payment(payment_id, order_id, when):
        return event("payment_processed", when, {"payment_id": payment_id, "order_id": order_id}, event_id=payment_id)

    payments, orders = (normalize_events(parse_events(replay.source())) for _ in range(2))
    stream = reconcile_payment_stream(payments, orders, "10 minutes", "1 minute")
    out = str(replay.root / "out")

    def step(*bodies):
        replay.add_events(*bodies)
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(replay.root / "c"))
         .trigger(availableNow=True).start().awaitTermination())
        return {(r.payment_id, r.status) for r in spark.read.parquet(out).collect()}

    assert step(order("a", at(0)), payment("p1", "a", at(1)), payment("p2", "late", at(1)),
                payment("p3", "never", at(1)), payment("p4", None, at(1))) == {("p1", "match")}
    assert step(order("late", at(1, 30))) == {("p1", "match"), ("p2", "match")}
    # The lower watermark of the two sides counts, and other events move neither.
    assert step(event(at=at(30)), order("y", at(30))) == {("p1", "match"), ("p2", "match")}
    found = {f for f in step(order("z", at(30)), payment("p9", "z", at(30))) if f[0] != "p9"}
    assert found == {("p1", "match"), ("p2", "match"), ("p3", "orphan"), ("p4", "orphan")}


def test_payments_without_an_order_are_dealt(spark):
    """A third of all payments may name no order: they are no single key, and those of one order keep theirs."""
    ids = spark.range(3000).select(F.col("id").cast("string").alias("event_id"),
                                   F.when(F.col("id") % 3 > 0, F.concat(F.lit("o"), F.col("id") % 7)).alias("order_id"))
    rows = dealt(ids, 4)
    assert rows.filter("order_id IS NULL").select("piece").distinct().count() == 1000
    assert rows.filter("order_id IS NOT NULL").select("order_id", "piece").distinct().count() == 28
    largest = rows.filter("order_id IS NULL").repartition(8, "order_id", "piece").groupBy(F.spark_partition_id()).count()
    assert largest.agg(F.max("count")).first()[0] < 250


def test_orphans_without_an_order_come_out_once(spark, replay):
    at = lambda minute: f"2026-03-07T12:{minute:02}:00Z"
    order = lambda i, when: event("order_created", at=when, payload={"order_id": i})
    payment = lambda p, i, when: event("payment_processed", at=when, payload={"payment_id": p, "order_id": i})
    payments, orders = (normalize_events(parse_events(replay.source())) for _ in range(2))
    out = str(replay.root / "out")

    def step(*bodies):
        replay.add_events(*bodies)
        (reconcile_payment_stream(payments, orders, "10 minutes", "1 minute", pieces=3).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", str(replay.root / "c")).trigger(availableNow=True).start().awaitTermination())
        return sorted((r.payment_id, r.status) for r in spark.read.parquet(out).collect())

    nameless = [payment(f"n{i}", None, at(1)) for i in range(20)]
    assert step(order("a", at(0)), payment("p", "a", at(1)), *nameless, nameless[0]) == [("p", "match")]
    found = [f for f in step(order("z", at(30)), payment("q", "z", at(30))) if f[0] != "q"]
    assert found == sorted([("p", "match"), ("n0", "orphan"), *[(f"n{i}", "orphan") for i in range(20)]])


def test_checkpoints_go_to_the_shared_folder(spark):
    assert checkpoint_location(spark, JobConfig(checkpoint_dir="/shared/x/")) == "/shared/x/metrics_realtime_1m"
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = MagicMock()
    unset.conf.get.return_value = None
    with pytest.raises(ValueError):
        shared_root(unset)


@pytest.mark.parametrize("end, code", [(None, 0), (KeyboardInterrupt(), 0), (RuntimeError("x"), 1)])
def test_exit_codes(monkeypatch, end, code):
    query, session = MagicMock(isActive=False), MagicMock()
    query.awaitTermination.side_effect = end
    monkeypatch.setattr(job, "read_kafka_stream", lambda spark, config: None)
    monkeypatch.setattr(job, "start_metrics", lambda records, config: query)
    assert job.run(JobConfig(), session) == code
    session.stop.assert_not_called()  # it is the caller's


@pytest.mark.parametrize("arguments, code", [(["--help"], 0), (["--shuffle-partitions", "none"], 2), (["--shuffle-partitions", "0"], 1)])
def test_the_entry_file_starts(arguments, code):
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "run_metrics_job.py")
    ended = subprocess.run([sys.executable, entry, *arguments], capture_output=True, text=True, cwd="/tmp", timeout=120)
    assert ended.returncode == code, ended.stderr
    assert "ModuleNotFoundError" not in ended.stderr


def test_command_line(monkeypatch):
    seen = []
    monkeypatch.setattr(job, "run", lambda config: seen.append(config) or 0)
    arguments = ["--topic", "t", "--window-duration", "5 minutes", "--shuffle-partitions", "64", "--fail-on-data-loss", "false"]
    assert job.main(arguments) == 0
    assert seen == [JobConfig(topic="t", window_duration="5 minutes", shuffle_partitions=64, fail_on_data_loss=False)]
