from __future__ import annotations

import glob
from datetime import date, datetime, timedelta, timezone
from unittest.mock import MagicMock

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from builders import as_set, event, events, utc
from conftest import SMALL_DIR
from pulse.config import JobConfig
from pulse.contract import EVENT_TYPES, METRIC_COLUMNS, METRIC_SCHEMA
from pulse.operators.metrics import build_metrics
from pulse.operators.parse import parse_events
from pulse.operators.validate import check_contract
from pulse.plans import insights, serving
from pulse.sinks import kafka as kafka_sink
from pulse.sinks import metric_table as mt
from pulse.sinks.archive import write_archive
from pulse.sources.kafka import source_options
from pulse.sources.records import read_records
from testkit.adapter import event_fields, event_records, flat_events, read_events
from testkit.faults import faulty_records


def metric_rows(spark, *rows):
    full = [(start, start, name, value, key, dim, start) for start, name, value, key, dim in rows]
    return spark.createDataFrame(full, METRIC_SCHEMA)


def row(day, hour, name="orders_per_minute", value=1.0, minute=0, key="scope", dim="all", month=3):
    return (utc(2026, month, day, hour, minute), name, value, key, dim)


def test_table_is_day_partitioned_and_sorted(spark, tmp_path):
    metrics = build_metrics(flat_events(read_events(spark, SMALL_DIR)))
    path = str(tmp_path / "t")
    mt.write_metric_table(metrics, path)
    days = glob.glob(f"{path}/window_date=*")
    assert len(days) == 30
    for file in glob.glob(f"{path}/window_date=*/run_id=*/batch_id=*/*.parquet"):
        table = pq.ParquetFile(file).read().to_pandas()
        keys = list(table[list(mt.SORT_KEY)].fillna("").itertuples(index=False, name=None))
        assert keys == sorted(keys)
    back = mt.read_metric_table(spark, path)
    assert as_set(back.drop("window_date", "processed_at")) == as_set(metrics.drop("processed_at"))


def test_overwriting_replaces_only_the_days_in_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    mt.write_metric_table(metric_rows(spark, row(1, 10), row(2, 10)), path)
    mt.write_metric_table(metric_rows(spark, row(2, 11, value=5.0)), path)
    assert {(r.window_start.day, r.metric_value) for r in mt.read_metric_table(spark, path).collect()} == {(1, 1.0), (2, 5.0)}


def test_missing_value_counts_as_zero(spark):
    assert mt.table_rows(metric_rows(spark, row(1, 10, value=None))).first().metric_value == 0.0


def test_a_bounded_read_touches_its_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    mt.write_metric_table(metric_rows(spark, *[row(d, h) for d in range(1, 9) for h in (0, 12)]), path)
    found = mt.read_metric_table(spark, path, datetime(2026, 3, 2, 6), datetime(2026, 3, 4, 6, tzinfo=timezone.utc))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert found.count() == 4
    assert mt.read_metric_table(spark, path, utc(2027, 1, 1), utc(2027, 1, 2)).count() == 0
    assert mt.read_metric_table(spark, path, utc(2020, 1, 1), utc(2027, 1, 2)).count() == 16
    assert mt.read_metric_table(spark, path, start=utc(2026, 3, 8)).count() == 2
    assert "window_date" in mt.read_metric_table(spark, path, start=utc(2026, 3, 8))._jdf.queryExecution().toString()


@pytest.mark.parametrize("days", [3, 4000])
def test_a_missing_table_is_an_error_for_any_range(spark, tmp_path, days):
    with pytest.raises(AnalysisException):
        mt.read_metric_table(spark, str(tmp_path / "none"), utc(2026, 1, 1), utc(2026, 1, 1) + timedelta(days=days))


def test_days_are_utc_days_in_any_zone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = metric_rows(spark, *[row(d, h) for d in (1, 2) for h in (0, 1, 12, 23)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        mt.write_metric_table(rows, path)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert mt.read_metric_table(spark, path, utc(2026, 3, 1), utc(2026, 3, 2, 23)).count() == 8
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_compaction_keeps_rows_and_leaves_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = metric_rows(spark, *[row(d, h) for d in (1, 2, 3) for h in range(6)])
    for run in ("a", "b", "c"):
        mt.write_metric_table(rows, path, run_id=run)
    before = as_set(mt.read_metric_table(spark, path).drop("processed_at"))
    assert mt.compact_metric_table(spark, path, date(2026, 3, 3)) == 2
    assert as_set(mt.read_metric_table(spark, path).drop("processed_at")) == before
    assert len(list((tmp_path / "t" / "window_date=2026-03-01").rglob("*.parquet"))) == 1
    assert len(list((tmp_path / "t" / "window_date=2026-03-03").rglob("*.parquet"))) >= 3
    assert mt.compact_metric_table(spark, path, date(2026, 3, 3)) == 0
    mt.write_metric_table(rows, path, run_id="late")
    assert mt.compact_metric_table(spark, path, date(2026, 3, 3)) == 2
    assert len(list((tmp_path / "t" / "window_date=2026-03-01").rglob("*.parquet"))) == 1


def test_latest_version_of_a_window(spark):
    old = metric_rows(spark, row(1, 10))
    new = old.withColumn("metric_value", F.lit(9.0)).withColumn("processed_at", F.current_timestamp())
    assert [r.metric_value for r in mt.latest_version(old.unionByName(new)).collect()] == [9.0]


def test_stream_writer_needs_a_stream(spark, tmp_path):
    with pytest.raises(RuntimeError):
        mt.metric_batch_writer(str(tmp_path))(metric_rows(spark, row(1, 10)), 0)


def test_jdbc_writer_appends_from_the_executors(monkeypatch):
    rows = MagicMock()
    monkeypatch.setattr(mt, "table_rows", lambda batch: rows)
    mt.jdbc_batch_writer({"url": "jdbc:x", "dbtable": "metrics_realtime_1m"}, 3)(MagicMock(), 0)
    rows.repartition.assert_called_once_with(3)
    writer = rows.repartition.return_value.write.format
    writer.assert_called_once_with("jdbc")
    writer.return_value.options.assert_called_once_with(url="jdbc:x", dbtable="metrics_realtime_1m")
    writer.return_value.options.return_value.mode.assert_called_once_with("append")


def test_series_are_bounded_and_ordered(spark):
    metrics = metric_rows(spark, row(1, 12, value=3.0), row(1, 10, value=1.0), row(1, 11, value=2.0),
                          row(1, 11, "revenue_per_minute", 7.0), row(2, 9, value=4.0))
    found = serving.metric_series(metrics, "orders_per_minute", utc(2026, 3, 1, 11), utc(2026, 3, 1, 12)).collect()
    assert [r.value for r in found] == [2.0, 3.0]


def test_throughput_and_latest(spark):
    by_type = [row(1, h, "events_per_minute", float(h), key="event_type", dim=d) for h in (10, 11) for d in ("a", "b")]
    metrics = metric_rows(spark, *by_type, row(1, 10, "active_users_per_minute", 5.0), row(1, 9, "active_users_per_minute", 8.0))
    assert [(r.metric, r.value) for r in serving.throughput_series(metrics).orderBy("time", "metric").collect()] == [
        ("a", 10.0), ("b", 10.0), ("a", 11.0), ("b", 11.0)]
    assert [r.asDict() for r in serving.throughput_table(metrics, ["a", "c"]).select("a", "c").collect()] == [
        {"a": 10.0, "c": None}, {"a": 11.0, "c": None}]
    assert [r.value for r in serving.latest_metric(metrics, "active_users_per_minute").collect()] == [5.0]
    for title in serving.PANELS:
        assert serving.panel(metrics, title).columns


def test_funnel_by_hand(spark):
    def at(s):
        return f"2026-03-07T18:00:{s:02d}Z"

    rows = events(
        spark,
        event("page_view", at(1), user_id="a"), event("add_to_cart", at(2), user_id="a"), event("order_created", at(3), user_id="a"),
        event("page_view", at(5), user_id="b"), event("add_to_cart", at(4), user_id="b"),
        event("page_view", at(1), user_id="c"), event("add_to_cart", at(9), user_id="c"), event("order_created", at(8), user_id="c"),
        event("order_created", at(8), user_id="d"), event("page_view", at(8), user_id=None),
    )
    found = insights.funnel(rows).collect()
    assert [(r.viewers, r.carters, r.buyers) for r in found] == [(3, 2, 1)]
    assert found[0].view_to_cart == pytest.approx(2 / 3)


def test_anomaly_history_crosses_slices(spark):
    rows = [row(1, 23, value=float(v), minute=50 + i) for i, v in enumerate((1, 3, 1, 3))] + [row(2, 0, value=10.0)]
    found = {(r.window_start.day, r.window_start.minute): r for r in insights.anomaly_scores(metric_rows(spark, *rows)).collect()}
    last = found[(2, 0)]
    assert len(found) == 5 and last.n_history == 4 and last.mean == 2.0
    assert last.z_score == pytest.approx((10 - 2) / (4 / 3) ** 0.5)
    assert found[(1, 50)].z_score is None and found[(1, 50)].n_history == 0
    with pytest.raises(ValueError):
        insights.anomaly_scores(metric_rows(spark, *rows), history="2 days", slice_length="1 day")


def test_alerts(spark):
    rules = insights.thresholds(spark, [("orders_per_minute", 2.0, 4.0, "warning"), ("other", None, 0.0, "info")])
    metrics = metric_rows(spark, *[row(1, h, value=float(h)) for h in range(1, 6)])
    found = {(r.metric_value, r.breach) for r in insights.alerts(metrics, rules).collect()}
    assert found == {(1.0, "below"), (5.0, "above")}


def test_archive_keeps_everything(spark, tmp_path):
    raw = faulty_records(read_events(spark, SMALL_DIR))
    path = str(tmp_path / "a")
    write_archive(check_contract(raw), path)
    back = spark.read.parquet(path)
    assert back.count() == raw.count()
    assert back.filter("raw_json IS NULL").count() == 0
    assert {r[0] for r in back.select("event_type_key").distinct().collect()} == {*EVENT_TYPES, "unknown"}
    assert back.filter("event_date IS NULL").count() == 0


def test_kafka_options():
    config = JobConfig(bootstrap_servers="b:9092", topic="t", starting_offsets="earliest", max_offsets_per_trigger=5,
                       min_partitions=12)
    assert source_options(config) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5", "minPartitions": "12"}
    assert "maxOffsetsPerTrigger" not in source_options(JobConfig())
    options = kafka_sink.sink_options(config)
    assert options["topic"] == "t" and options["kafka.acks"] == "all" and options["kafka.compression.type"] == "lz4"
    assert "topic" not in kafka_sink.sink_options(config, with_topic=False)


def test_published_records_are_valid_and_keyed_by_user(spark):
    with pytest.raises(ValueError):
        kafka_sink.to_kafka_records(flat_events(read_events(spark, SMALL_DIR)))
    flat = event_fields(read_events(spark, SMALL_DIR))
    out = kafka_sink.to_kafka_records(flat)
    assert out.columns == ["key", "value"]
    checked = check_contract(out)
    assert checked.filter("NOT is_valid").count() == 0
    assert checked.filter("kafka_key <> user_id").count() == 0
    names = ["event_id", "stock_after", "total_amount", "reason"]
    first = parse_events(event_records(read_events(spark, SMALL_DIR))).select(names)
    assert parse_events(out).select(names).exceptAll(first).count() == 0


def test_records_from_files(spark, tmp_path):
    raw = event_records(read_events(spark, SMALL_DIR))
    raw.write.parquet(str(tmp_path / "p"))
    raw.select(F.col("value").cast("string")).write.text(str(tmp_path / "t"))
    names = ["event_id", "event_type", "total_amount"]
    expected = as_set(parse_events(raw).select(names))
    assert as_set(parse_events(read_records(spark, str(tmp_path / "p"))).select(names)) == expected
    assert as_set(parse_events(read_records(spark, str(tmp_path / "t"), "text")).select(names)) == expected


def test_config_is_checked():
    for bad in ({"starting_offsets": "now"}, {"topic": " "}, {"shuffle_partitions": 0}, {"min_partitions": -1}):
        with pytest.raises(ValueError):
            JobConfig(**bad)
    conf = JobConfig(shuffle_partitions=64, extra_conf={"a": "b"}).session_conf()
    assert conf["spark.sql.shuffle.partitions"] == "64" and conf["a"] == "b"
    assert conf["spark.sql.session.timeZone"] == "UTC" and "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]
    assert JobConfig().query_name == "event-metrics-query" and list(METRIC_COLUMNS)[-1] == "processed_at"


def test_a_backlog_of_one_day_fills_as_many_files_as_it_has_rows(spark, tmp_path):
    start = F.timestamp_seconds(F.lit(1_772_841_600) + F.col("id") * 60)
    rows = spark.range(1200).select(
        start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"), F.lit("m").alias("metric_name"),
        F.col("id").cast("double").alias("metric_value"), F.lit("scope").alias("dimension_key"), F.lit("all").alias("dimension_value"),
        F.current_timestamp().alias("processed_at"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(METRIC_SCHEMA).parquet(str(tmp_path / "in"))
    for rows_per_file, least, most in ((100, 8, 20), (5000, 1, 2)):
        path = str(tmp_path / f"table-{rows_per_file}")
        (stream.writeStream.foreachBatch(mt.metric_batch_writer(path, rows_per_file)).trigger(availableNow=True)
         .option("checkpointLocation", f"{path}-checkpoint").start().awaitTermination())
        table = spark.read.parquet(path)
        assert table.count() == 1200 and least <= len(table.inputFiles()) <= most


def test_a_relative_range_ends_now(spark):
    recent = serving.recent
    start, end = recent()
    assert end - start == timedelta(minutes=30) and abs(datetime.now(timezone.utc) - end) < timedelta(minutes=1)
    assert recent(timedelta(hours=2), datetime(2026, 3, 7, 18)) == (datetime(2026, 3, 7, 16), datetime(2026, 3, 7, 18))
    with pytest.raises(ValueError):
        recent(timedelta(0))
