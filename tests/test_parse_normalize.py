from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from builders import PAYLOADS, event, events, records, text, utc
from pulse.config import JobConfig
from pulse.contract import EVENT_CONTRACT, EVENT_TYPES, METRIC_COLUMNS, METRIC_SCHEMA, Field
from pulse.operators.normalize import drop_future_events, normalize_events
from pulse.operators.parse import parse_events

FLAT = [f"kafka_{c}" for c in ("key", "topic", "partition", "offset", "timestamp")] + EVENT_CONTRACT.flat_names


def test_contract_shapes():
    assert len(EVENT_CONTRACT.payload_schema().fields) == 19
    assert [f.name for f in EVENT_CONTRACT.envelope_schema()][-1] == "payload"
    assert EVENT_CONTRACT.event_types == list(EVENT_TYPES)
    assert METRIC_SCHEMA.names == list(METRIC_COLUMNS)


def test_contract_can_be_extended():
    more = EVENT_CONTRACT.extended("refund_issued", (Field("refund_id", low=1, high=64), Field("order_id", high=64)))
    assert more.event_types[-1] == "refund_issued" and more.flat_names[-1] == "refund_id"
    assert "refund_issued" in next(f for f in more.envelope if f.name == "event_type").choices
    with pytest.raises(ValueError):
        EVENT_CONTRACT.extended("x", (Field("quantity"),)).payload_fields
    with pytest.raises(ValueError):
        EVENT_CONTRACT.extended("x", (Field("user_id"),))


def test_parse_gives_31_columns_of_the_declared_types(spark):
    parsed = parse_events(records(spark, *[event(t) for t in PAYLOADS]))
    assert parsed.columns == FLAT and len(FLAT) == 31
    types = dict(parsed.dtypes)
    assert types["quantity"] == "int" and types["total_amount"] == "double" and types["event_time"] == "string"
    order = parsed.filter("event_type = 'order_created'").first()
    assert (order.order_id, order.items_count, order.total_amount, order.channel) == ("first-order", 6, 61.25, "web")
    assert order.page is None and order.stock_after is None


def test_parse_some_fields_gives_the_same_values(spark):
    raw = records(spark, *[event(t) for t in PAYLOADS])
    some = ["event_type", "user_id", "total_amount"]
    assert sorted(parse_events(raw, fields=some).select(some).collect()) == sorted(
        parse_events(raw).select(some).collect())
    with pytest.raises(ValueError):
        parse_events(raw, fields=["nothing"])


@pytest.mark.parametrize("body", ['{"event_id":"a",', "hello", "null", '[{"event_id":"x"}]'])
def test_malformed_text_is_a_row_of_nulls_until_the_time_filter(spark, body):
    raw = records(spark, body)
    assert parse_events(raw).select(EVENT_CONTRACT.flat_names).collect() == [(None,) * 26]
    assert normalize_events(parse_events(raw)).count() == 0


@pytest.mark.parametrize("body", [None, "", "  \n\t"])
def test_records_without_content_are_dropped(spark, body):
    assert parse_events(records(spark, body)).count() == 0


def test_one_bad_field_is_null_alone(spark):
    bodies = [
        event("add_to_cart", payload={"quantity": "x"}),
        event("add_to_cart", payload={"quantity": 3.0}),
        event("add_to_cart", payload={"quantity": 99999999999}),
        event("order_created", payload={"total_amount": "9.5"}),
        event(event_id=5),
        text(event()).replace('"event_id"', '"EVENT_ID"'),
        text(event()).replace('"event_id": "evt_1"', '"event_id": "first", "event_id": "last"'),
    ]
    rows = parse_events(records(spark, *bodies)).orderBy("kafka_offset").collect()
    assert [r.quantity for r in rows[:3]] == [None] * 3 and rows[0].unit_price == 12.25
    assert rows[3].total_amount is None and rows[3].items_count == 6
    assert [r.event_id for r in rows[4:]] == ["5", None, "last"]


@pytest.mark.parametrize(
    "at, kept",
    [
        ("2026-03-07T18:14:02Z", True), ("2026-03-07T18:14:02+00:00", True), ("2026-03-07T15:14:02-03:00", True),
        ("2026-03-07T18:14:02", True), ("2026-03-07T18:14:02.000000Z", True),
        ("yesterday", False), ("", False), ("1772907242", False), (None, False),
    ],
)
def test_time_formats(spark, at, kept):
    rows = events(spark, event(at=at)).select(F.unix_seconds("event_ts")).collect()
    assert [r[0] for r in rows] == ([int(utc(2026, 3, 7, 18, 14, 2).timestamp())] if kept else [])


def test_numeric_defaults_and_flags(spark):
    stock = [None, 0, 1, 10, 11]
    bodies = [event("inventory_updated", payload={"stock_after": s}) for s in stock]
    bodies += [event("payment_processed", payload={"payment_status": s}) for s in ("approved", "declined", "pending")]
    bodies += [event("order_created", payload={"total_amount": "bad"}), event("page_view")]
    rows = events(spark, *bodies).orderBy("kafka_offset").collect()
    assert [r.low_stock_flag for r in rows[:5]] == [0.0, 0.0, 1.0, 1.0, 0.0]
    assert [r.payment_approved_flag for r in rows[5:8]] == [1.0, 0.0, 0.0]
    assert [r.payment_attempt_flag for r in rows] == [0.0] * 5 + [1.0] * 3 + [0.0] * 2
    assert rows[8].total_amount == 0.0 and rows[8].order_event_flag == 1.0 and rows[9].page_view_flag == 1.0
    assert rows[9].quantity == 0 and rows[9].unit_price == 0.0 and rows[9].active_user_flag == "42"


def test_future_events_can_be_dropped(spark):
    base = events(spark, event(at="2026-03-07T18:10:00Z"), event(at="2026-03-07T18:30:00Z"))
    dated = base.withColumn("kafka_timestamp", F.timestamp_seconds(F.lit(int(utc(2026, 3, 7, 18, 12).timestamp()))))
    assert drop_future_events(dated, "5 minutes").count() == 1
    assert drop_future_events(base, "5 minutes").count() == 2
    guarded = normalize_events(parse_events(records(spark, event())), JobConfig(max_event_skew="5 minutes"))
    assert guarded.count() == 1
