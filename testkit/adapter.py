"""The test tables' `events` as contract events: scaffolding for tests, bench and checks.

`event_records` builds broker records with JSON values, so the whole decode path
runs; `flat_events` gives the same events as typed columns, the shape of an
archived event table. Both are plain projections of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.contract import EVENT_CONTRACT
from pulse.functions.columns import iso_utc, once
from pulse.operators.normalize import normalize_events

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENTS_DDL)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


# Fixed values of the mapping, column by column; n is the event id, k the number in props.
BASE = (
    "event_id AS n",
    "cast(event_id AS string) AS event_id",
    "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'order_created'"
    " WHEN 'signup' THEN 'payment_processed' WHEN 'error' THEN 'inventory_updated' END AS event_type",
    "cast(ts AS timestamp) AS event_at",
    "cast(ts AS timestamp) + make_dt_interval(0, 0, 0, event_id % 21) AS produced_at",
    "cast(user_id AS string) AS user_id",
    "cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k",
    "value",
)
ENVELOPE = ("event_id", "event_type", "event_at", "produced_at", "user_id",
            "concat('sess_', user_id) AS session_id", "'testdata' AS source")
PAYLOAD = {
    "page": "CASE WHEN event_type = 'page_view' THEN '/product' END",
    "product_id": "CASE WHEN event_type IN ('page_view', 'add_to_cart', 'inventory_updated')"
                  " THEN concat('item-', n % 13) END",
    "category": "CASE WHEN event_type = 'page_view' THEN concat('shelf-', n % 3) END",
    "referrer": "CASE WHEN event_type = 'page_view' THEN 'direct' END",
    "quantity": "CASE WHEN event_type = 'add_to_cart' THEN 1 + k % 4 END",
    "unit_price": "CASE WHEN event_type = 'add_to_cart' THEN value END",
    "currency": "CASE WHEN event_type IN ('add_to_cart', 'order_created', 'payment_processed') THEN 'BRL' END",
    "order_id": "CASE event_type WHEN 'order_created' THEN concat('ord_', n)"
                " WHEN 'payment_processed' THEN concat('ord_', n - 1) END",
    "items_count": "CASE WHEN event_type = 'order_created' THEN 1 + k % 5 END",
    "total_amount": "CASE WHEN event_type = 'order_created' THEN value END",
    "channel": "CASE WHEN event_type = 'order_created' THEN 'web' END",
    "payment_id": "CASE WHEN event_type = 'payment_processed' THEN concat('pay_', n) END",
    "payment_method": "CASE WHEN event_type = 'payment_processed' THEN"
                      " element_at(array('credit_card', 'pix', 'debit_card', 'wallet', 'boleto'), int(n % 5) + 1) END",
    "payment_status": "CASE WHEN event_type = 'payment_processed' THEN"
                      " CASE WHEN k < 82 THEN 'approved' WHEN k < 94 THEN 'declined' ELSE 'pending' END END",
    "amount": "CASE WHEN event_type = 'payment_processed' THEN value END",
    "warehouse_id": "CASE WHEN event_type = 'inventory_updated' THEN concat('wh_0', 1 + n % 3) END",
    "delta_qty": "CASE WHEN event_type = 'inventory_updated' THEN k - 50 END",
    "stock_after": "CASE WHEN event_type = 'inventory_updated' THEN k END",
    "reason": "CASE WHEN event_type = 'inventory_updated' THEN 'adjustment' END",
}


def event_fields(events: DataFrame) -> DataFrame:
    """Envelope and payload columns, times as ISO-8601 text."""
    columns = [f"{sql} AS {name}" for name, sql in PAYLOAD.items()]
    mapped = events.selectExpr(*BASE).selectExpr(*ENVELOPE, *columns)
    times = {"event_time": iso_utc(F.col("event_at")), "producer_time": iso_utc(F.col("produced_at"))}
    return mapped.withColumns(times).select(*EVENT_CONTRACT.flat_names)


def json_value() -> Column:
    envelope = ", ".join(f.name for f in EVENT_CONTRACT.envelope)
    return F.expr(f"to_json(struct({envelope}, struct({', '.join(PAYLOAD)}) AS payload))")


def as_records(fields: DataFrame) -> DataFrame:
    """Broker records of the events; the JSON text is built once per event."""
    return once(fields, "json", json_value()).select(
        F.col("user_id").cast("binary").alias("key"),
        F.col("json").cast("binary").alias("value"),
        F.lit("events.raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.try_to_timestamp("producer_time").alias("timestamp"),
    )


def event_records(events: DataFrame) -> DataFrame:
    return as_records(event_fields(events))


def flat_events(events: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Normalised events without the JSON round trip."""
    broker = ("user_id AS kafka_key", "'events.raw' AS kafka_topic", "0 AS kafka_partition",
              "bigint(event_id) AS kafka_offset", "try_to_timestamp(producer_time) AS kafka_timestamp")
    return normalize_events(event_fields(events).selectExpr(*broker, "*"), config)
