from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from builders import as_set, event, events
from conftest import SF_DIR
from pulse.contract import EVENT_TYPES
from pulse.operators.continuity import stock_continuity
from pulse.operators.monitor import dedup_events, event_mix, producer_lag, route_topics
from pulse.operators.reconcile import payment_matches, payment_orphans, reconcile_payments
from testkit.adapter import flat_events, read_events


def order(order_id, at="2026-03-07T18:00:00Z", amount=10.0, user="u", **changes):
    return event("order_created", at, {"order_id": order_id, "total_amount": amount}, user_id=user,
                 event_id=f"o-{order_id}-{at}", **changes)


def payment(payment_id, order_id, amount=10.0, user="u", at="2026-03-07T18:00:05Z", **changes):
    return event("payment_processed", at, {"payment_id": payment_id, "order_id": order_id, "amount": amount, **changes},
                 user_id=user, event_id=f"p-{payment_id}")


def test_reconciliation_by_hand(spark):
    rows = events(
        spark,
        order("o1"), order("o2", amount=20.0), order("o1", at="2026-03-07T18:30:00Z", amount=99.0),
        payment("p1", "o1"), payment("p2", "o2", amount=19.0, user="v"), payment("p3", "never"),
        payment("p4", None), payment("p5", "o1", currency="USD"),
    )
    found = {r.payment_id: (r.status, r.differences) for r in reconcile_payments(rows).collect()}
    assert found == {
        "p1": ("match", ""), "p2": ("mismatch", "amount,user_id"), "p3": ("orphan", None), "p4": ("orphan", None),
        "p5": ("mismatch", "currency"),
    }
    assert {r.payment_id for r in payment_orphans(rows).collect()} == {"p3", "p4"}
    assert {r.payment_id for r in payment_matches(rows).collect()} == {"p1", "p2", "p5"}


def test_reconciliation_against_brute_force_with_a_hot_order(spark):
    rng = random.Random(11)
    orders = [order(f"o{i}", amount=float(i)) for i in range(15)]
    paid = [("o0" if rng.random() < 0.4 else f"o{rng.randint(0, 30)}", float(rng.randint(0, 15))) for _ in range(200)]
    rows = events(spark, *orders, *[payment(f"p{i}", o, a) for i, (o, a) in enumerate(paid)])
    expected = Counter("orphan" if int(o[1:]) >= 15 else "match" if a == float(o[1:]) else "mismatch" for o, a in paid)
    found = Counter(r.status for r in reconcile_payments(rows).select("status").collect())
    assert found == expected


def test_matched_and_orphaned_payments_of_the_table(spark):
    rows = flat_events(read_events(spark, SF_DIR))
    counts = {r.orphan: r["count"] for r in reconcile_payments(rows).groupBy(
        (F.col("status") == "orphan").alias("orphan")).count().collect()}
    assert counts == {True: 1620, False: 397}


def move(i, product, at, delta, stock, warehouse="wh_01"):
    return event("inventory_updated", at, {"product_id": product, "delta_qty": delta, "stock_after": stock,
                                           "warehouse_id": warehouse}, event_id=f"{i:05d}")


def test_moves_without_product_or_id_have_no_previous_level(spark):
    rows = events(spark, *[event("inventory_updated", f"2026-03-07T18:00:0{i}Z", {"product_id": None, "stock_after": 10 + i},
                                 event_id=None) for i in range(3)])
    assert [r.previous_stock for r in stock_continuity(rows).collect()] == [None] * 3


def test_records_without_id_and_place_are_not_duplicates(spark):
    rows = events(spark, *[event(event_id=None, user_id=str(i)) for i in range(5)]).withColumn(
        "kafka_offset", F.lit(None).cast("bigint"))
    assert dedup_events(rows).count() == 5


def test_the_earliest_copy_stays(spark):
    rows = events(spark, event(user_id="late"), event(user_id="early"), event(user_id="later"))
    placed = rows.withColumn("kafka_timestamp", F.expr(
        "timestamp_seconds(CASE user_id WHEN 'early' THEN 1 WHEN 'late' THEN 2 ELSE 3 END)"))
    assert [r.user_id for r in dedup_events(placed).collect()] == ["early"]


def test_continuity_by_hand(spark):
    rows = events(
        spark,
        move(1, "a", "2026-03-07T18:00:00Z", 5, 5), move(2, "a", "2026-03-07T18:00:01Z", -5, 0, "wh_02"),
        move(3, "a", "2026-03-07T18:00:01Z", 0, 0), move(4, "a", "2026-03-08T00:00:00Z", 7, 7),
        move(5, "a", "2026-03-08T09:00:00Z", 7, 7), move(6, "b", "2026-03-07T18:00:00Z", 1, 1),
    )
    found = {r.event_id: (r.previous_stock, r.is_continuous) for r in stock_continuity(rows).collect()}
    assert found == {"00001": (None, None), "00002": (5, True), "00003": (0, True), "00004": (0, True),
                     "00005": (7, False), "00006": (None, None)}


@pytest.mark.parametrize("slice_length", ["1 second", "1 minute", "10 days"])
def test_continuity_does_not_depend_on_the_slices(spark, slice_length):
    rng = random.Random(5)
    bodies = [move(i, rng.choice(["hot", "hot", "x", "y"]), f"2026-03-07T18:{rng.randint(0, 9):02d}:{rng.randint(0, 59):02d}Z",
                   rng.randint(-3, 3), rng.randint(0, 9)) for i in range(150)]
    last, expected = {}, {}
    for b in sorted(bodies, key=lambda b: (b["producer_time"], b["event_id"])):
        p = b["payload"]
        expected[b["event_id"]] = last.get(p["product_id"])
        last[p["product_id"]] = p["stock_after"]
    found = {r.event_id: r.previous_stock for r in stock_continuity(events(spark, *bodies), slice_length).collect()}
    assert found == expected


def test_moves_without_a_product_have_no_previous_level(spark):
    rows = events(spark, *[move(i, None, f"2026-03-07T18:00:0{i}Z", 0, 5) for i in range(3)])
    assert [r.previous_stock for r in stock_continuity(rows).collect()] == [None] * 3


def test_continuity_keeps_moves_without_a_producer_time(spark):
    rows = events(spark, move(1, "a", "2026-03-07T18:00:00Z", 5, 5),
                  {**move(2, "a", "2026-03-07T18:00:01Z", 1, 6), "producer_time": "soon"})
    assert {r.event_id: r.is_continuous for r in stock_continuity(rows).collect()} == {"00001": None, "00002": True}


def test_producer_lag(spark):
    rows = events(spark, *[event(at="2026-03-07T18:00:00Z", producer_time=f"2026-03-07T18:00:{s:02d}Z")
                           for s in (0, 4, 8)], event(producer_time="soon"))
    found = producer_lag(rows).collect()
    assert len(found) == 1
    assert (found[0].n_events, found[0].avg_lag, found[0].max_lag, found[0].p50_lag) == (3, 4.0, 8.0, 4.0)


def test_event_mix(spark):
    rows = events(spark, event("page_view"), event("page_view"), event("order_created"), event("refund"))
    found = {r.event_type: (r.n_events, r.share, r.expected_share) for r in event_mix(rows).collect()}
    assert found["page_view"] == (2, 0.5, 0.45) and found["unknown"] == (1, 0.25, 0.0)
    assert found["add_to_cart"] == (0, 0.0, 0.20) and len(found) == 6
    assert event_mix(rows.limit(0)).count() == 6


def test_dedup_keeps_one_per_id_and_all_without(spark):
    rows = events(spark, event(event_id="a"), event(event_id="a"), event(event_id="b"), event(event_id=None),
                  event(event_id=None))
    kept = dedup_events(rows.withColumns({"kafka_topic": F.lit("t"), "kafka_partition": F.lit(0)}))
    assert Counter(r.event_id for r in kept.collect()) == {"a": 1, "b": 1, None: 2}
    assert kept.columns == rows.columns


def test_topics(spark):
    routed = route_topics(events(spark, *[event(t) for t in (*EVENT_TYPES, "refund")]))
    assert as_set(routed.select("event_type", "topic")) == {
        ("page_view", "events.web"), ("add_to_cart", "events.commerce"), ("order_created", "events.commerce"),
        ("payment_processed", "events.payments"), ("inventory_updated", "events.inventory"), ("refund", "events.raw")}
