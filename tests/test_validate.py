from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from builders import PAYLOADS, event, records, text
from conftest import SF_DIR, SMALL_DIR
from pulse.contract import EVENT_CONTRACT, EVENT_TYPES, Field
from pulse.operators.parse import parse_events
from pulse.operators.validate import _looked_up, apply_contract_defaults, canonical_times, check_contract, split_by_contract
from testkit.adapter import event_records, read_events
from testkit.faults import faulty_records

BIG = "x" * 129
CASES = [
    (None, ["empty_value"]),
    (" ", ["empty_value"]),
    ('{"event_id":"a",', ["malformed_json"]),
    ("hello", ["malformed_json"]),
    ("null", ["not_an_object"]),
    ("[1]", ["not_an_object"]),
    ('"text"', ["not_an_object"]),
    ("{}", [f"missing:{n}" for n in [f.name for f in EVENT_CONTRACT.envelope] + ["payload"]]),
    (event(), []),
    (event(without=["user_id"]), ["missing:user_id"]),
    (event(user_id=""), ["length:user_id"]),
    (event(user_id="u" * 64), []),
    (event(user_id="u" * 65), ["length:user_id"]),
    (event(event_id=BIG), ["length:event_id"]),
    (event(event_id=5), ["type:event_id"]),
    (event(source=None), ["type:source"]),
    (event("refund"), ["enum:event_type"]),
    (event(event_type=3), ["type:event_type"]),
    (event(extra=1), ["unknown:extra"]),
    (event(payload={"note": "x"}), ["unknown:note"]),
    (event(payload=None, without=["payload"]), ["missing:payload"]),
    ({**event(), "payload": 3}, ["type:payload"]),
    ({**event(), "payload": None}, ["type:payload"]),
    ({**event(), "payload": [1]}, ["type:payload"]),
    (event(payload={"quantity": 1}), ["forbidden:quantity"]),
    (event(without=["referrer"]), []),
    (event(payload={"referrer": None}), ["type:referrer"]),
    (event(at="yesterday"), ["timestamp:event_time", "timestamp:producer_time"]),
    (event(at="2026-03-07T18:14:02"), []),
    (event(at="2026-03-07T15:14:02.25-03:00"), []),
    (event(at="2026-03-07"), ["timestamp:event_time", "timestamp:producer_time"]),
    (event(at="2026-02-30T00:00:00Z"), ["timestamp:event_time", "timestamp:producer_time"]),
    (event("add_to_cart", payload={"quantity": 0}), ["range:quantity"]),
    (event("add_to_cart", payload={"quantity": 100}), []),
    (event("add_to_cart", payload={"quantity": 101}), ["range:quantity"]),
    (event("add_to_cart", payload={"quantity": 99999999999}), ["range:quantity"]),
    (event("add_to_cart", payload={"quantity": 2.5}), ["type:quantity"]),
    (event("add_to_cart", payload={"quantity": 3.0}), []),
    (text(event("add_to_cart")).replace("12.25", "1e400"), ["range:unit_price"]),
    (text(event()) + " and more", ["malformed_json"]),
    (text(event()) + text(event()), ["malformed_json"]),
    (text(event()) + "] [", ["malformed_json"]),
    (text(event()).replace('"page": ', '"page": "x", "page": '), []),
    (text(event()).replace('"user_id": ', '"user_id": "x", "user_id": '), []),
    (event("add_to_cart", payload={"quantity": "2"}), ["type:quantity"]),
    (event("add_to_cart", payload={"quantity": True}), ["type:quantity"]),
    (event("add_to_cart", payload={"unit_price": 80}), []),
    (event("add_to_cart", payload={"unit_price": -0.01}), ["range:unit_price"]),
    (event("add_to_cart", payload={"currency": "BR"}), ["length:currency"]),
    (event("add_to_cart", without=["currency"]), []),
    (event("order_created", without=["currency"]), ["missing:currency"]),
    (event("order_created", payload={"items_count": 1001}), ["range:items_count"]),
    (event("order_created", payload={"total_amount": "9.5"}), ["type:total_amount"]),
    (event("payment_processed", payload={"payment_method": "cash"}), ["enum:payment_method"]),
    (event("payment_processed", payload={"payment_status": "APPROVED"}), ["enum:payment_status"]),
    (event("inventory_updated", payload={"delta_qty": -100000, "stock_after": 1000000}), []),
    (event("inventory_updated", payload={"delta_qty": -100001}), ["range:delta_qty"]),
    (event("inventory_updated", payload={"stock_after": -1}), ["range:stock_after"]),
    (event("inventory_updated", payload={"reason": "theft"}), ["enum:reason"]),
    (event("inventory_updated", without=["reason"]), []),
    (
        {**event("payment_processed"), "payload": PAYLOADS["page_view"]},
        ["missing:payment_id", "missing:order_id", "missing:payment_method", "missing:payment_status",
         "missing:amount", "forbidden:category", "forbidden:page", "forbidden:product_id", "forbidden:referrer"],
    ),
]


def test_every_rule(spark):
    checked = check_contract(records(spark, *[body for body, _ in CASES])).orderBy("kafka_offset").collect()
    for (body, expected), row in zip(CASES, checked, strict=True):
        assert sorted(row.violations) == sorted(expected), text(body)
        assert row.is_valid == (not expected)


def test_all_five_types_are_accepted(spark):
    checked = check_contract(records(spark, *[event(t) for t in EVENT_TYPES]))
    assert [r.violations for r in checked.collect()] == [[]] * 5


def test_valid_and_rejected_are_the_input(spark):
    raw = faulty_records(read_events(spark, SF_DIR))
    valid, rejected = split_by_contract(check_contract(raw))
    n_valid, n_rejected = valid.count(), rejected.count()
    assert n_valid + n_rejected == raw.count() and n_rejected > 0
    assert valid.filter(F.size("violations") > 0).count() == 0
    assert rejected.filter(F.size("violations") == 0).count() == 0


def test_flat_columns_are_those_of_the_parser(spark):
    raw = event_records(read_events(spark, SMALL_DIR))
    parsed, checked = parse_events(raw), check_contract(raw)
    assert checked.filter("NOT is_valid").count() == 0
    assert checked.select(parsed.columns).exceptAll(parsed).count() == 0


def test_a_further_event_type(spark):
    more = EVENT_CONTRACT.extended("refund_issued", (Field("refund_id", low=1, high=8), Field("order_id", high=64)))
    bodies = [event("refund_issued", payload={"refund_id": "r1", "order_id": "o"}),
              event("refund_issued", payload={"refund_id": "r23456789", "order_id": "o"}), event("page_view")]
    rows = check_contract(records(spark, *bodies), more).orderBy("kafka_offset").collect()
    assert [r.violations for r in rows] == [[], ["length:refund_id"], []]
    assert parse_events(records(spark, bodies[0]), more).first().refund_id == "r1"


def test_defaults_apply_to_their_own_type_only(spark):
    bodies = [event("page_view", without=["referrer"]), event("add_to_cart", without=["currency"]),
              event("order_created", without=["currency", "channel"]), event("payment_processed", without=["currency"]),
              event("inventory_updated", without=["reason"]), event("page_view", payload={"referrer": "email"})]
    rows = apply_contract_defaults(parse_events(records(spark, *bodies))).orderBy("kafka_offset").collect()
    found = [(r.referrer, r.currency, r.channel, r.reason) for r in rows]
    assert found == [("direct", None, None, None), (None, "BRL", None, None), (None, None, "web", None),
                     (None, "BRL", None, None), (None, None, None, "adjustment"), ("email", None, None, None)]


@pytest.mark.parametrize(
    "given, canonical",
    [
        ("2026-03-07T15:30:00Z", "2026-03-07T15:30:00+00:00"),
        ("2026-03-07T15:30:00", "2026-03-07T15:30:00+00:00"),
        ("2026-03-07T12:30:00.5-03:00", "2026-03-07T15:30:00.500000+00:00"),
        ("yesterday", "yesterday"),
    ],
)
def test_canonical_times(spark, given, canonical):
    assert canonical_times(parse_events(records(spark, event(at=given)))).first().event_time == canonical


def test_no_variants_are_carried_to_the_rules(spark):
    """Each variant of a map holds the names of the whole record, and every step would copy them."""
    looked_up, _ = _looked_up(records(spark, text(event(extra=1))), [EVENT_CONTRACT])
    assert not [kind for _, kind in looked_up.dtypes if "variant" in kind]
