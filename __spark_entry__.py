"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pulse.config import JobConfig
from pulse.contract import EVENT_CONTRACT, EVENT_TYPES, Contract
from pulse.operators import metrics as M
from pulse.operators.continuity import stock_continuity
from pulse.operators.monitor import dedup_events, event_mix, mix_drift, producer_lag, route_topics
from pulse.operators.normalize import NUMERIC_DEFAULTS, drop_future_events, normalize_events
from pulse.operators import sketches as K
from pulse.operators.parse import parse_events
from pulse.operators.reconcile import payment_matches, payment_orphans, reconcile_payments
from pulse.operators.validate import (
    apply_contract_defaults,
    canonical_times,
    check_contract,
    check_versions,
    split_by_contract,
    verdict_changes,
    violation_counts,
)
from pulse.plans import insights, serving
from pulse.plans.repair import repair, uncounted
from pulse.plans.pipeline import metrics_from_records
from pulse.schema_file import read_contract, schema_of_contract
from pulse.sinks.archive import archive_writer, write_archive
from pulse.sinks.kafka import to_kafka_records
from pulse.sinks.metric_table import (
    compact_metric_table,
    metric_batch_writer,
    read_metric_table,
    write_metric_table,
)
from pulse.sinks.sketch_table import read_sketch_table, sketch_batch_writer, write_sketch_table
from pulse.sources.records import read_records
from pulse.streaming.anomaly import anomaly_score_stream
from pulse.streaming.continuity import stock_continuity_stream
from pulse.streaming.job import configure, start_metrics
from pulse.streaming.late import late_router, lateness, routed_events
from pulse.streaming.ledger import ledger_writer, unique_events
from pulse.streaming.reconcile import reconcile_payment_stream
from testkit.adapter import event_fields, event_records, flat_events, read_events, stream_events
from testkit.faults import faulty_records
from testkit.replay import replay_files, replayed
from testkit.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def _with_workers(query: Query) -> Query:
    """Let Python workers import the library from here, wherever the driver was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return query(spark, sf_dir)

    return run


try:  # the operators for training-data pipelines are a separate part that may be absent
    import corpus_pipeline
    from pulse.llm.oracles import ORACLES as LLM_ORACLES
    from pulse.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as absent:
    if absent.name != "corpus_pipeline" and not f"{absent.name}.".startswith("pulse.llm."):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {name: _with_workers(query) for name, query in (LLM_QUERIES | {"pipeline": corpus_pipeline.run}).items()}
    LLM_ORACLES = LLM_ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

CONFIG = JobConfig()
DAILY = JobConfig(window_duration="1 day", slide_duration="1 day")
SLIDING = JobConfig(window_duration="5 minutes", slide_duration="1 minute")
RANGE = (datetime(2024, 1, 5), datetime(2024, 1, 20, 12))
ALERT_RULES = (
    ("payment_success_rate", 0.5, None, "critical"),
    ("events_per_minute", None, 2.0, "info"),
    ("revenue_per_minute", None, 90.0, "warning"),
)


# ---- inputs ---------------------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as broker records with JSON values."""
    configure(spark, CONFIG)
    return event_records(read_events(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised events as an archived table would give them, without the JSON round trip."""
    configure(spark, CONFIG)
    return flat_events(read_events(spark, sf_dir))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark, CONFIG)
    return check_contract(faulty_records(read_events(spark, sf_dir)))


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the other engine has them, and doubles free of summation noise."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif field.dataType.typeName() == "double":
            column = F.round(column, 6) + F.lit(0.0)  # no negative zero
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _rows(metrics: DataFrame) -> DataFrame:
    return _plain(metrics.drop("processed_at", "window_date"))


def _metric(name: str, config: JobConfig = CONFIG, among=M.METRICS_EXACT) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rows(metrics_from_records(_records(spark, sf_dir), config, M.named(name, among=among)))

    return query


def _exact_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_metrics(_events(spark, sf_dir), CONFIG, M.METRICS_EXACT)


# ---- queries --------------------------------------------------------------------------------


def parsed(spark, sf_dir):
    return _plain(parse_events(_records(spark, sf_dir)))


def normalized(spark, sf_dir):
    events = normalize_events(parse_events(_records(spark, sf_dir)))
    return _plain(
        events.select(
            "event_id", "event_type", "event_ts", "producer_ts", *NUMERIC_DEFAULTS,
            "payment_approved_flag", "payment_attempt_flag", "low_stock_flag", "order_event_flag",
            "page_view_flag", "active_user_flag",
        )
    )


def skew_filtered(spark, sf_dir):
    """Every seventh event lies a minute ahead of its broker time."""
    early = F.when(F.col("event_id").cast("bigint") % 7 == 0, F.col("event_ts") - F.expr("INTERVAL 60 SECONDS"))
    events = _events(spark, sf_dir).withColumn("kafka_timestamp", F.coalesce(early, "kafka_timestamp"))
    return _plain(drop_future_events(events, "10 seconds").select("event_id", "event_ts"))


def _exact_where_near(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Approximate user counts replaced by the exact ones where they keep their error bound."""
    known = exact.filter(F.col("metric_name") == "active_users_per_minute").select(
        "metric_name", "window_start", "window_end", F.col("metric_value").alias("exact"))
    near = F.abs(F.col("metric_value") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.2 * F.col("exact"))
    joined = approximate.join(known, ["metric_name", "window_start", "window_end"], "left")
    return joined.withColumn("metric_value", F.when(near, F.col("exact")).otherwise(F.col("metric_value"))).drop("exact")


def active_users(spark, sf_dir):
    """The shipped, approximate metric; where a count keeps its error bound, the exact one stands for it."""
    both = [metrics_from_records(_records(spark, sf_dir), CONFIG, M.named("active_users_per_minute", among=among))
            for among in (M.METRICS, M.METRICS_EXACT)]
    return _rows(_exact_where_near(*both))


def metrics_of_faulty(spark, sf_dir):
    """Throughput from records with empty values, malformed text and bad times."""
    configure(spark, CONFIG)
    records = faulty_records(read_events(spark, sf_dir))
    return _rows(metrics_from_records(records, CONFIG, M.named("events_per_minute")))


def metrics_of_files(spark, sf_dir):
    """Records written to files, without broker columns, and read back by the bounded source."""
    path = scratch_dir(spark, "records")
    _records(spark, sf_dir).select("value").write.parquet(path)
    return _rows(metrics_from_records(read_records(spark, path), CONFIG, M.METRICS_EXACT))


def all_metrics(spark, sf_dir):
    """All six metrics from JSON records in one pass, users counted exactly."""
    return _rows(metrics_from_records(_records(spark, sf_dir), CONFIG, M.METRICS_EXACT))


def sliding_metrics(spark, sf_dir):
    return _rows(metrics_from_records(_records(spark, sf_dir), SLIDING, M.METRICS_EXACT))


def active_users_accuracy(spark, sf_dir):
    """The approximate count beside the exact one, as a verdict on its error."""
    both = (M.named("active_users_per_minute"), M.named("active_users_per_minute", among=M.METRICS_EXACT))
    approximate, exact = (M.build_metrics(_events(spark, sf_dir), DAILY, metric) for metric in both)
    exact = exact.select("window_start", F.col("metric_value").alias("exact_users"))
    near = F.abs(F.col("metric_value") - F.col("exact_users")) <= F.greatest(F.lit(1.0), 0.2 * F.col("exact_users"))
    joined = approximate.join(exact, "window_start")
    return _plain(joined.select("window_start", "exact_users", near.alias("within_bound")))


def active_users_shipped(spark, sf_dir):
    """The shipped metric of every minute judged against the exact count: three of its standard errors."""
    both = [metrics_from_records(_records(spark, sf_dir), CONFIG, M.named("active_users_per_minute", among=among))
            for among in (M.METRICS, M.METRICS_EXACT)]
    keys = ["window_start", "window_end"]
    exact = both[1].select(*keys, F.col("metric_value").alias("exact_users"))
    near = K.within_errors(F.col("metric_value"), F.col("exact_users"), 0.05)
    return _plain(both[0].join(exact, keys, "full").select(*keys, "exact_users", F.coalesce(near, F.lit(False)).alias("within_errors")))


#: Windows that are rolled up from stored minutes.
GRAINS = (("sliding", "5 minutes", "1 minute"), ("hour", "1 hour", "1 hour"), ("day", "1 day", "1 day"))


def _judged(rolled: DataFrame, events: DataFrame, duration: str, slide: str) -> DataFrame:
    """Rolled up users beside the exact count and beside a sketch made of the events themselves."""
    config, keys = JobConfig(window_duration=duration, slide_duration=slide), ["window_start", "window_end"]
    window = F.window("event_ts", duration, slide)
    exact = events.groupBy(window.start.alias("window_start"), window.end.alias("window_end")).agg(
        F.count_distinct("user_id").alias("exact_users"))
    direct = K.window_sketches(events, config).select(*keys, K.active_users(F.col("users_sketch")).alias("direct"))
    found = rolled.withColumn("estimate", K.active_users(F.col("users_sketch"))).join(exact, keys, "full").join(direct, keys, "full")
    return found.select(
        *keys, "n_events", "exact_users", (F.col("estimate") == F.col("direct")).alias("as_from_events"),
        K.within_errors(F.col("estimate"), F.col("exact_users"), K.users_error()).alias("within_errors"))


def user_rollups(spark, sf_dir):
    """Users of longer windows from a table of minutes, without the events; sketches of minutes made from JSON records."""
    path = scratch_dir(spark, "sketches")
    write_sketch_table(K.window_sketches(normalize_events(parse_events(_records(spark, sf_dir)))), path)
    minutes, events = read_sketch_table(spark, path), _events(spark, sf_dir)
    found = None
    for grain, duration, slide in GRAINS:
        judged = _judged(K.roll_up(minutes, duration, slide), events, duration, slide).select(F.lit(grain).alias("grain"), "*")
        found = judged if found is None else found.unionByName(judged)
    return _plain(found)


def lag_rollup(spark, sf_dir):
    """Hours' lag quantiles from stored minutes: how far their rank in the events is from the one asked for."""
    path, keys = scratch_dir(spark, "lag-sketches"), ["window_start", "window_end"]
    events = _events(spark, sf_dir)
    write_sketch_table(K.window_sketches(events), path)
    hours = K.roll_up(read_sketch_table(spark, path), "1 hour")
    asked = (0.5, 0.95, 0.99)
    hours = hours.select(*keys, "n_events", K.lag_quantiles(F.col("lag_sketch"), asked).alias("found"))
    window, lag = F.window("event_ts", "1 hour"), (F.unix_micros("producer_ts") - F.unix_micros("event_ts")) / 1_000_000
    lags = events.select(window.start.alias("window_start"), window.end.alias("window_end"), lag.alias("lag"))
    ranks = [f(F.col("lag"), F.col("found")[i]) for i in range(len(asked))
             for f in (lambda a, b: F.avg((a < b).cast("int")), lambda a, b: F.avg((a <= b).cast("int")))]
    judged = lags.join(hours, keys).groupBy(*keys, "n_events").agg(*(r.alias(f"r{i}") for i, r in enumerate(ranks)))
    near = [(F.col(f"r{2 * i}") - K.LAG_RANK_ERROR <= q) & (F.col(f"r{2 * i + 1}") + K.LAG_RANK_ERROR >= q) for i, q in enumerate(asked)]
    return _plain(judged.select(*keys, "n_events", *(n.alias(f"p{int(100 * q)}_in_rank") for n, q in zip(near, asked))))


def stream_user_sketches(spark, sf_dir):
    """Minutes that closed in a stream, stored as sketches and rolled up to hours without the events."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-sketches")
    sketches = K.window_sketches(normalize_events(parse_events(event_records(stream_events(spark, sf_dir)))))
    (sketches.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).foreachBatch(sketch_batch_writer(f"{root}/table")).start().awaitTermination())
    minutes, events = read_sketch_table(spark, f"{root}/table"), _events(spark, sf_dir)
    last = minutes.agg(F.max("window_end").alias("last"))
    closed = events.join(last, F.col("event_ts") < F.col("last")).drop("last")  # one row, of the minutes' table
    return _plain(_judged(K.roll_up(minutes, "1 hour"), closed, "1 hour", "1 hour"))


_TABLES: dict[tuple[str, str], str] = {}


def _metric_table(spark: SparkSession, sf_dir: str) -> str:
    """A table that holds every window twice, of an earlier run and a later one; made once for each session."""
    made = (spark.sparkContext.applicationId, sf_dir)
    if made not in _TABLES:
        path = scratch_dir(spark, "metric-table")
        metrics = _exact_metrics(spark, sf_dir)
        stale = metrics.withColumns({"metric_value": F.col("metric_value") + 7,
                                     "processed_at": F.col("processed_at") - F.expr("INTERVAL 1 DAY")})
        write_metric_table(stale, path, run_id="earlier")
        write_metric_table(metrics, path)
        _TABLES[made] = path
    return _TABLES[made]


def _served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_metric_table(spark, _metric_table(spark, sf_dir), *RANGE)


def metric_table(spark, sf_dir):
    """Written to a day-partitioned table and read back for a range."""
    return _rows(_served(spark, sf_dir))


def metric_table_other_zone(spark, sf_dir):
    """Written and read under session zones that are not UTC."""
    zone, path = spark.conf.get("spark.sql.session.timeZone"), scratch_dir(spark, "metric-table-zone")
    _exact_metrics(spark, sf_dir).write.parquet(f"{path}-metrics")  # the test table's times have no zone of their own
    metrics = spark.read.parquet(f"{path}-metrics")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        write_metric_table(metrics, path)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        read_metric_table(spark, path, *RANGE).write.parquet(f"{path}-read")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return _rows(spark.read.parquet(f"{path}-read"))


def metric_table_compacted(spark, sf_dir):
    """Two runs put together for all days before the last ones."""
    path = scratch_dir(spark, "metric-table-compacted")
    metrics = _exact_metrics(spark, sf_dir)
    stale = metrics.withColumns({"metric_value": F.col("metric_value") + 7,
                                 "processed_at": F.col("processed_at") - F.expr("INTERVAL 1 DAY")})
    write_metric_table(stale, path, run_id="earlier")
    write_metric_table(metrics, path)
    compact_metric_table(spark, path, date(2024, 1, 15))
    return _rows(read_metric_table(spark, path, *RANGE))


def metric_series(spark, sf_dir):
    return _plain(serving.metric_series(_served(spark, sf_dir), "revenue_per_minute", *RANGE))


def orders_series(spark, sf_dir):
    return _plain(serving.panel(_served(spark, sf_dir), "Orders per Minute", *RANGE))


def success_series(spark, sf_dir):
    return _plain(serving.panel(_served(spark, sf_dir), "Payment Success Rate", *RANGE))


def recent_panels(spark, sf_dir):
    """All panels of the last six hours before a fixed moment, as a dashboard with a relative range asks for them."""
    bounds = serving.recent(timedelta(hours=6), now=datetime(2024, 1, 20, 12))
    table = read_metric_table(spark, _metric_table(spark, sf_dir), *bounds)
    found = None
    for title, (_, _, form) in serving.PANELS.items():
        rows = serving.panel(table, title, *bounds)
        series = F.col("metric") if form == "series_by_type" else F.lit(None).cast("string")
        rows = rows.select(F.lit(title).alias("panel"), "time", series.alias("series"), "value")
        found = rows if found is None else found.unionByName(rows)
    return _plain(found)


def throughput_series(spark, sf_dir):
    return _plain(serving.throughput_series(_served(spark, sf_dir), *RANGE))


def throughput_table(spark, sf_dir):
    types = ["page_view", "add_to_cart", "order_created", "payment_processed", "inventory_updated"]
    return _plain(serving.throughput_table(_served(spark, sf_dir), types, *RANGE))


def latest_metric(spark, sf_dir):
    return _plain(serving.latest_metric(_served(spark, sf_dir), None, *RANGE))


def contract_violations(spark, sf_dir):
    return violation_counts(_checked(spark, sf_dir))


def contract_verdicts(spark, sf_dir):
    reasons = F.concat_ws(",", "violations").alias("reasons")
    return _checked(spark, sf_dir).select("kafka_offset", "is_valid", reasons)


def _from_file(spark: SparkSession, contract: Contract) -> Contract:
    """The contract, written as a schema file and compiled from it."""
    path = scratch_dir(spark, "schema")
    spark.createDataFrame([(json.dumps(schema_of_contract(contract), indent=2),)], "value string").coalesce(1).write.text(path)
    return read_contract(spark, path)


def schema_file_verdicts(spark, sf_dir):
    """The verdicts of the contract that is compiled from its schema file."""
    configure(spark, CONFIG)
    checked = check_contract(faulty_records(read_events(spark, sf_dir)), _from_file(spark, EVENT_CONTRACT))
    return checked.select("kafka_offset", "is_valid", F.concat_ws(",", "violations").alias("reasons"))


def schema_version_changes(spark, sf_dir):
    """What a version with an optional user and sessions of any length changes for the records."""
    configure(spark, CONFIG)
    wider = {"user_id": {"required": False}, "session_id": {"low": None}}
    heads = tuple(replace(f, **wider.get(f.name, {})) for f in EVENT_CONTRACT.envelope)
    versions = {"v1": EVENT_CONTRACT, "v2": Contract(heads, EVENT_CONTRACT.payloads)}
    compiled = {name: _from_file(spark, contract) for name, contract in versions.items()}
    return verdict_changes(check_versions(faulty_records(read_events(spark, sf_dir)), compiled), "v1", "v2")


def rejected_events(spark, sf_dir):
    return split_by_contract(_checked(spark, sf_dir))[1].select("kafka_offset", F.size("violations").alias("n_reasons"))


def contract_defaults(spark, sf_dir):
    optional = ["referrer", "currency", "channel", "reason"]
    bare = _events(spark, sf_dir).withColumns({name: F.lit(None).cast("string") for name in optional})
    return apply_contract_defaults(bare).select("event_id", "event_type", *optional)


def utc_times(spark, sf_dir):
    """Times written with three kinds of offset, brought to one form."""
    events = _events(spark, sf_dir)
    number = F.col("event_id").cast("bigint")
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    shifted = F.date_format(F.col("event_ts") - F.expr("INTERVAL 3 HOURS"), pattern + "'-03:00'")
    text = (
        F.when(number % 3 == 0, F.date_format("event_ts", pattern + "'Z'"))
        .when(number % 3 == 1, F.date_format("event_ts", pattern))
        .otherwise(shifted)
    )
    return canonical_times(events.withColumn("event_time", text)).select("event_id", "event_time", "producer_time")


def _paid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, with one order that many payments and several order events name, and payments without an order id."""
    number = F.col("event_id").cast("bigint")
    payment, order = F.col("event_type") == "payment_processed", F.col("event_type") == "order_created"
    hot = (payment & (number % 5 == 0)) | (order & (number % 97 == 0))
    order_id = F.when(hot, "ord_hot").when(payment & (number % 11 == 0), None).otherwise(F.col("order_id"))
    return _events(spark, sf_dir).withColumn("order_id", order_id)


def payment_status(spark, sf_dir):
    return _plain(reconcile_payments(_paid_events(spark, sf_dir)))


def orphans(spark, sf_dir):
    return _plain(payment_orphans(_paid_events(spark, sf_dir)))


def order_match(spark, sf_dir):
    return _plain(payment_matches(_paid_events(spark, sf_dir)))


def continuity(spark, sf_dir):
    found = stock_continuity(_events(spark, sf_dir))
    return _plain(found.withColumn("is_continuous", F.col("is_continuous").cast("int")))


def continuity_keyless(spark, sf_dir):
    """Every third inventory event names neither product nor id."""
    bare = F.col("event_id").cast("bigint") % 3 == 0
    events = _events(spark, sf_dir).withColumn("product_id", F.when(~bare, F.col("product_id"))).withColumn(
        "kafka_offset", F.lit(None).cast("bigint"))
    found = stock_continuity(events.withColumn("event_id", F.when(~bare, F.col("event_id"))))
    return _plain(found.withColumn("is_continuous", F.col("is_continuous").cast("int")))


def lag(spark, sf_dir):
    lags = producer_lag(_events(spark, sf_dir), DAILY)
    return _plain(lags.select("window_start", "window_end", "n_events", "avg_lag", "max_lag"))


def lag_quantiles(spark, sf_dir):
    return _plain(producer_lag(_events(spark, sf_dir), DAILY))


def mix(spark, sf_dir):
    return _plain(event_mix(_events(spark, sf_dir)))


def dedup(spark, sf_dir):
    """Every event twice; the later copy of the broker differs."""
    events = _events(spark, sf_dir)
    later = events.withColumns({"kafka_timestamp": F.col("kafka_timestamp") + F.expr("INTERVAL 5 SECONDS"),
                                "total_amount": F.col("total_amount") + 1})
    twice = dedup_events(later.unionByName(events))
    return _plain(twice.select("event_id", "event_type", "event_ts", "user_id", "order_id", "total_amount"))


def dedup_keyless(spark, sf_dir):
    """Every event twice, from files; every third has no id and so is like no other."""
    events = _events(spark, sf_dir).withColumns(
        {c: F.lit(None).cast(t) for c, t in (("kafka_offset", "bigint"), ("kafka_topic", "string"), ("kafka_partition", "int"))})
    number = F.col("event_id").cast("bigint")
    some = events.withColumn("n", number).withColumn("event_id", F.when(number % 3 != 0, F.col("event_id")))
    return _plain(dedup_events(some.unionByName(some)).select("n", "event_id", "event_type", "event_ts"))


def published(spark, sf_dir):
    """Events written as broker records and parsed again."""
    configure(spark, CONFIG)
    parsed_again = parse_events(to_kafka_records(event_fields(read_events(spark, sf_dir))))
    return _plain(parsed_again.select("kafka_key", *[c for c in parsed_again.columns if not c.startswith("kafka_")]))


def topics(spark, sf_dir):
    routed = route_topics(_events(spark, sf_dir))
    return routed.groupBy("topic", "event_type").agg(F.count(F.lit(1)).alias("n_events"))


def archive(spark, sf_dir):
    path = scratch_dir(spark, "archive")
    write_archive(_checked(spark, sf_dir), path)
    return _archive_counts(spark, path)


def _archive_counts(spark: SparkSession, path: str) -> DataFrame:
    day = F.col("event_date").cast("string").alias("event_date")
    return spark.read.parquet(path).groupBy("verdict", "event_type_key", day).agg(
        F.count(F.lit(1)).alias("n_records"), F.count("raw_json").alias("n_raw")
    )


def funnel(spark, sf_dir):
    return _plain(insights.funnel(_events(spark, sf_dir), DAILY))


def anomalies(spark, sf_dir):
    return _rows(insights.anomaly_scores(_exact_metrics(spark, sf_dir)))


def metric_alerts(spark, sf_dir):
    rules = insights.thresholds(spark, ALERT_RULES)
    found = insights.alerts(_exact_metrics(spark, sf_dir), rules)
    return _plain(found.select("window_start", "metric_name", "dimension_value", "metric_value", "severity", "breach"))


def episodes(spark, sf_dir):
    """Alert episodes of the whole table, breaches up to ten minutes apart being one."""
    found = insights.alerts(_exact_metrics(spark, sf_dir), insights.thresholds(spark, ALERT_RULES))
    return _plain(insights.alert_episodes(found, "10 minutes"))


#: Days on which every third event is turned into a page view.
SHIFTED_DAYS = (5, 17)


def drift(spark, sf_dir):
    """Days whose event mix departs from equal shares, two of them planted."""
    shifted = F.day("event_ts").isin(*SHIFTED_DAYS) & (F.col("event_id").cast("bigint") % 3 == 0)
    events = _events(spark, sf_dir).withColumn("event_type", F.when(shifted, "page_view").otherwise(F.col("event_type")))
    return _plain(mix_drift(events, DAILY, dict.fromkeys(EVENT_TYPES, 1.0)))


# ---- streaming: the same tables replayed until the source is exhausted --------------------------


def stream_metrics(spark, sf_dir):
    """The streaming job over the whole table; rows of windows that closed.

    A stream counts users approximately; where a count keeps its error bound, the exact one stands for it.
    """
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-metrics")
    config = JobConfig(app_name=f"replay-{os.path.basename(root)}", checkpoint_dir=f"{root}/checkpoints")
    records = event_records(stream_events(spark, sf_dir))
    query = start_metrics(records, config, metric_batch_writer(f"{root}/table"), available_now=True)
    query.awaitTermination()
    return _rows(_exact_where_near(read_metric_table(spark, f"{root}/table"), _exact_metrics(spark, sf_dir)))


def stream_payments(spark, sf_dir):
    """Stream-stream reconciliation; payments whose bound the watermark has passed, and all matches."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-payments")
    payments = flat_events(stream_events(spark, sf_dir), CONFIG)
    # Every order is delivered twice.
    orders = flat_events(stream_events(spark, sf_dir).select("*", F.explode(F.array(F.lit(1), F.lit(2)))), CONFIG)
    reconciled = reconcile_payment_stream(payments, orders, before="1 hour", after="1 minute")
    _drain(reconciled, f"{root}/out", f"{root}/checkpoint")
    return _plain(spark.read.parquet(f"{root}/out").select("event_id", "order_id", "order_ts", "status"))


def stream_dedup(spark, sf_dir):
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-dedup")
    events = flat_events(stream_events(spark, sf_dir).select("*", F.explode(F.array(F.lit(1), F.lit(2)))), CONFIG)
    _drain(dedup_events(events).select("event_id", "event_type", "event_ts"), f"{root}/out", f"{root}/checkpoint")
    return _plain(spark.read.parquet(f"{root}/out"))


def stream_archive(spark, sf_dir):
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-archive")
    checked = check_contract(faulty_records(stream_events(spark, sf_dir)))
    query = archive_writer(checked, f"{root}/out", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return _archive_counts(spark, f"{root}/out")


#: Parts of a replay, each a micro-batch. An event goes up to a minute later than it happened, so neighbouring files overlap in time.
REPLAY_FILES, REPLAY_DAYS = 6, 30


def _replayed(spark: SparkSession, sf_dir: str, root: str, late: bool = False, copies: bool = False) -> DataFrame:
    """The events as a stream of several micro-batches, out of order within and between them.

    With ``late``, every fiftieth event comes two files later than its time. With ``copies``, every third comes again one
    file later and every fifth two files later, days after the watermark has passed it.
    """
    events = read_events(spark, sf_dir)
    seen = F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") % 60
    first = F.unix_seconds(F.lit(datetime(2024, 1, 1)).cast("timestamp"))
    part = F.floor((seen - first) / (REPLAY_DAYS * 86400 // REPLAY_FILES))
    rows = events.select("*", part.alias("part"))
    if late:
        rows = rows.withColumn("part", F.col("part") + 2 * (F.col("event_id") % 50 == 7).cast("int"))
    for later, every in ((1, 3), (2, 5)) if copies else ():
        again = events.select("*", (part + later).alias("part")).filter(F.col("event_id") % every == 0)
        rows = rows.unionByName(again)
    parted = rows.withColumn("__part", F.least("part", F.lit(REPLAY_FILES - 1))).drop("part")
    files = replay_files(parted, REPLAY_FILES, f"{root}/replay")
    return replayed(spark, f"{root}/replay", events.schema, files)


def _routed(spark: SparkSession, sf_dir: str) -> tuple[str, StructType]:
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-late")
    records = event_records(_replayed(spark, sf_dir, root, late=True))
    routed = normalize_events(parse_events(records)).select("event_id", "event_type", "event_ts")
    (routed.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
     .foreachBatch(late_router(f"{root}/routed")).start().awaitTermination())
    return f"{root}/routed", routed.schema


def stream_late_events(spark, sf_dir):
    """Every event of a replay with its micro-batch and whether it was late there; late ones lie aside."""
    return _plain(routed_events(spark, *_routed(spark, sf_dir)).select("event_id", "event_ts", "batch_id", "verdict"))


def stream_lateness(spark, sf_dir):
    """The ledger of the same replay: counts of both verdicts and the watermark of each micro-batch."""
    return _plain(lateness(spark, _routed(spark, sf_dir)[0]))


#: Metrics whose values do not depend on how often a sketch was merged.
COUNTED = tuple(m for m in M.METRICS if m.name != "active_users_per_minute")


def _streamed_with_late(spark: SparkSession, sf_dir: str) -> str:
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-repair")
    config = JobConfig(app_name=f"replay-{os.path.basename(root)}", checkpoint_dir=f"{root}/checkpoints")
    records = event_records(_replayed(spark, sf_dir, root, late=True))
    start_metrics(records, config, metric_batch_writer(f"{root}/table"), COUNTED, available_now=True).awaitTermination()
    return f"{root}/table"


def stream_stamps(spark, sf_dir):
    """The processing times in a stream's table: one for each micro-batch, later in later ones."""
    rows = read_metric_table(spark, _streamed_with_late(spark, sf_dir), every_version=True)
    batches = rows.groupBy("run_id", "batch_id").agg(
        F.count_distinct("processed_at").alias("stamps"), F.min("processed_at").alias("at"), F.max("window_end").alias("last"))
    # A micro-batch's stamp against the one that closed windows before it; a table has few batches in a replay.
    later = batches.alias("a").join(batches.alias("b"), (F.col("a.run_id") == F.col("b.run_id")) & (F.col("a.batch_id") + 1 == F.col("b.batch_id")), "left")
    in_order = F.coalesce((F.col("a.at") < F.col("b.at")) & (F.col("a.last") <= F.col("b.last")), F.lit(True))
    return later.agg(F.max("a.stamps").alias("stamps_per_batch"), F.every(in_order).alias("in_order"))


def late_by_window(spark, sf_dir):
    """What a stream's table lacks of the archive, by window and type."""
    table = read_metric_table(spark, _streamed_with_late(spark, sf_dir))
    return _plain(uncounted(_events(spark, sf_dir), table))


def repaired_metrics(spark, sf_dir):
    """A stream's table after the windows that missed late events were computed again."""
    path = _streamed_with_late(spark, sf_dir)
    events = _events(spark, sf_dir)
    repair(events, uncounted(events, read_metric_table(spark, path)), path, "repair-1", CONFIG, COUNTED)
    return _rows(read_metric_table(spark, path))


def stream_episodes(spark, sf_dir):
    """Episodes of a stream that reads a metric table, once the watermark has passed them."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-episodes")
    metrics = _exact_metrics(spark, sf_dir)
    day = F.floor((F.unix_seconds("window_start") - F.unix_seconds(F.lit(datetime(2024, 1, 1)).cast("timestamp"))) / (86400 * 5))
    files = replay_files(metrics.withColumn("__part", day), REPLAY_FILES, f"{root}/metrics")
    rows = replayed(spark, f"{root}/metrics", metrics.schema, files).withWatermark("window_start", "1 minute")
    found = insights.alert_episodes(insights.alerts(rows, insights.thresholds(spark, ALERT_RULES)), "10 minutes")
    _drain(found, f"{root}/out", f"{root}/checkpoint")
    return _plain(spark.read.parquet(f"{root}/out"))


def stream_dedup_ledger(spark, sf_dir):
    """Each event once, though copies come days after the watermark has passed them."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-ledger")
    events = flat_events(_replayed(spark, sf_dir, root, copies=True)).select(
        "event_id", "event_type", "event_ts", *(f"kafka_{c}" for c in ("topic", "partition", "offset", "timestamp")))
    (events.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
     .foreachBatch(ledger_writer(f"{root}/unique")).start().awaitTermination())
    return _plain(unique_events(spark, f"{root}/unique", events.schema).select("event_id", "event_type", "event_ts"))


def stream_anomalies(spark, sf_dir):
    """Scores of the metric windows that a stream of several micro-batches has closed."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-anomalies")
    metrics = M.build_metrics(flat_events(_replayed(spark, sf_dir, root)), CONFIG, COUNTED)
    _drain(anomaly_score_stream(metrics), f"{root}/out", f"{root}/checkpoint")
    return _plain(spark.read.parquet(f"{root}/out"))


def stream_funnel(spark, sf_dir):
    """The funnel of the days that a stream of several micro-batches has closed."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-funnel")
    found = insights.funnel(flat_events(_replayed(spark, sf_dir, root)), DAILY)
    _drain(found, f"{root}/out", f"{root}/checkpoint")
    return _plain(spark.read.parquet(f"{root}/out"))


def stream_continuity(spark, sf_dir):
    """Stock continuity on a stream whose moves arrive out of order; moves of closed time."""
    configure(spark, CONFIG)
    root = scratch_dir(spark, "stream-continuity")
    found = stock_continuity_stream(flat_events(_replayed(spark, sf_dir, root)))
    _drain(found.withColumn("is_continuous", F.col("is_continuous").cast("int")), f"{root}/out", f"{root}/checkpoint")
    return _plain(spark.read.parquet(f"{root}/out"))


def _drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


# ---- contract with the driver -------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: all six metrics of the small table in one pass."""
    return metrics_from_records(_records(spark, "/root/testdata/sf0.001"), CONFIG)


def queries() -> dict[str, Query]:
    return {
        "parse_events": parsed,
        "normalize_events": normalized,
        "future_event_filter": skew_filtered,
        "events_per_minute": _metric("events_per_minute"),
        "revenue_per_minute": _metric("revenue_per_minute"),
        "orders_per_minute": _metric("orders_per_minute"),
        "payment_success_rate": _metric("payment_success_rate"),
        "active_users_exact": _metric("active_users_per_minute"),
        "active_users_per_minute": active_users,
        "metrics_of_faulty_records": metrics_of_faulty,
        "metrics_of_file_records": metrics_of_files,
        "active_users_accuracy": active_users_accuracy,
        "active_users_shipped": active_users_shipped,
        "user_rollups": user_rollups,
        "producer_lag_rollup": lag_rollup,
        "low_stock_signals_per_minute": _metric("low_stock_signals_per_minute"),
        "all_metrics": all_metrics,
        "sliding_revenue_5m_1m": _metric("revenue_per_minute", SLIDING),
        "sliding_metrics_5m_1m": sliding_metrics,
        "metric_table": metric_table,
        "metric_table_other_zone": metric_table_other_zone,
        "metric_table_compacted": metric_table_compacted,
        "metric_series": metric_series,
        "orders_series": orders_series,
        "success_series": success_series,
        "throughput_series": throughput_series,
        "recent_panels": recent_panels,
        "throughput_table": throughput_table,
        "latest_metric": latest_metric,
        "contract_violations": contract_violations,
        "contract_verdicts": contract_verdicts,
        "schema_file_verdicts": schema_file_verdicts,
        "schema_version_changes": schema_version_changes,
        "rejected_events": rejected_events,
        "contract_defaults": contract_defaults,
        "utc_times": utc_times,
        "payment_status": payment_status,
        "payment_orphans": orphans,
        "payment_order_match": order_match,
        "stock_continuity": continuity,
        "stock_continuity_keyless": continuity_keyless,
        "producer_lag": lag,
        "producer_lag_quantiles": lag_quantiles,
        "event_mix": mix,
        "dedup_events": dedup,
        "dedup_keyless": dedup_keyless,
        "published_records": published,
        "topic_routing": topics,
        "archive": archive,
        "funnel": funnel,
        "anomaly_zscore": anomalies,
        "alerts": metric_alerts,
        "alert_episodes": episodes,
        "event_mix_drift": drift,
        "stream_metrics": stream_metrics,
        "stream_payments": stream_payments,
        "stream_dedup": stream_dedup,
        "stream_archive": stream_archive,
        "stream_user_sketches": stream_user_sketches,
        "stream_funnel": stream_funnel,
        "stream_alert_episodes": stream_episodes,
        "stream_dedup_ledger": stream_dedup_ledger,
        "stream_anomaly_zscore": stream_anomalies,
        "stream_stock_continuity": stream_continuity,
        "stream_late_events": stream_late_events,
        "stream_lateness": stream_lateness,
        "late_by_window": late_by_window,
        "stream_processed_at": stream_stamps,
        "repaired_metrics": repaired_metrics,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    from testkit.oracle import ORACLE

    return ORACLE | LLM_ORACLES
