"""Hand-written events for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators.normalize import normalize_events
from pulse.operators.parse import parse_events

# One valid payload per event type.
PAYLOADS = {
    "page_view": {"page": "/garden/tools", "product_id": "item-7", "category": "shelf-2", "referrer": "newsletter"},
    "add_to_cart": {"product_id": "item-8", "quantity": 5, "unit_price": 12.25, "currency": "BRL"},
    "order_created": {"order_id": "first-order", "items_count": 6, "total_amount": 61.25, "currency": "BRL",
                      "channel": "web"},
    "payment_processed": {"payment_id": "first-payment", "order_id": "first-order", "payment_method": "pix",
                          "payment_status": "approved", "amount": 61.25, "currency": "BRL"},
    "inventory_updated": {"product_id": "item-9", "warehouse_id": "north", "delta_qty": -7, "stock_after": 35,
                          "reason": "sale"},
}
_MISSING = object()


def event(event_type="page_view", at="2026-03-07T18:14:02+00:00", payload=None, without=(), **changes) -> dict:
    body = {
        "event_id": "evt_1", "event_type": event_type, "event_time": at, "producer_time": at, "user_id": "42",
        "session_id": "sess_1", "source": "web",
        "payload": {**PAYLOADS.get(event_type, {}), **(payload or {})},
    }
    body.update(changes)
    for name in without:
        body["payload"].pop(name, None)
        body.pop(name, None)
    return body


def text(body) -> str | None:
    return body if body is None or isinstance(body, str) else json.dumps(body)


def records(spark: SparkSession, *bodies) -> DataFrame:
    rows = [(text(b), i) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "value string, offset bigint").withColumn("value", F.col("value").cast("binary"))


def events(spark: SparkSession, *bodies) -> DataFrame:
    return normalize_events(parse_events(records(spark, *bodies)))


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def values(metrics: DataFrame, name: str) -> dict:
    """(minute of the window start, dimension value) -> value."""
    rows = metrics.filter(F.col("metric_name") == name).select(
        F.date_format("window_start", "HH:mm").alias("at"), "dimension_value", "metric_value"
    )
    return {(r["at"], r["dimension_value"]): r["metric_value"] for r in rows.collect()}


def as_set(df: DataFrame) -> set:
    return {tuple(r) for r in df.collect()}
