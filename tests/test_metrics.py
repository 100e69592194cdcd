from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from builders import PAYLOADS, as_set, event, events, values
from conftest import SF_DIR, SMALL_DIR
from pulse.config import JobConfig
from pulse.contract import EVENT_TYPES, METRIC_COLUMNS, METRIC_SCHEMA
from pulse.operators import metrics as M
from pulse.operators.metrics import build_metrics, named
from pulse.operators.normalize import normalize_events
from pulse.operators.parse import parse_events
from pulse.plans.pipeline import metrics_from_records
from testkit.adapter import event_records, flat_events, read_events


def minute(i: int, second: float = 0) -> str:
    return f"2026-03-07T18:{i:02d}:{second:09.6f}Z"


def test_columns_and_types(spark):
    metrics = build_metrics(events(spark, event()))
    assert metrics.columns == list(METRIC_COLUMNS)
    assert [f.dataType for f in metrics.schema] == [f.dataType for f in METRIC_SCHEMA]


def test_window_is_half_open(spark):
    metrics = build_metrics(events(spark, event(at=minute(0, 59.999999)), event(at=minute(1))))
    assert values(metrics, "events_per_minute") == {("18:00", "page_view"): 1.0, ("18:01", "page_view"): 1.0}


def test_values_by_hand(spark):
    bodies = [event("order_created", minute(0), {"total_amount": x}, user_id=u) for x, u in ((10.5, "a"), (4.25, "b"))]
    bodies += [event("order_created", minute(0), {"total_amount": "9.5"}, user_id="a")]
    bodies += [event("payment_processed", minute(0), {"payment_status": s}, user_id="c")
               for s in ("approved", "declined", "pending")]
    bodies += [event("inventory_updated", minute(0), {"stock_after": s}, user_id=None) for s in (0, 5, 10, 11)]
    metrics = build_metrics(events(spark, *bodies))
    scope = ("18:00", "all")
    assert values(metrics, "revenue_per_minute") == {scope: 14.75}
    assert values(metrics, "orders_per_minute") == {scope: 3.0}
    assert values(metrics, "payment_success_rate") == {scope: pytest.approx(1 / 3)}
    assert values(metrics, "active_users_per_minute") == {scope: 3.0}
    assert values(metrics, "low_stock_signals_per_minute") == {scope: 2.0}
    assert values(metrics, "events_per_minute") == {
        ("18:00", "order_created"): 3.0, ("18:00", "payment_processed"): 3.0, ("18:00", "inventory_updated"): 4.0}


def test_metrics_without_data_have_no_row(spark):
    found = {r.metric_name for r in build_metrics(events(spark, event("page_view"))).collect()}
    assert found == {"events_per_minute", "active_users_per_minute"}


def test_low_stock_is_zero_where_nothing_is_low(spark):
    metrics = build_metrics(events(spark, event("inventory_updated", minute(0), {"stock_after": 500})))
    assert values(metrics, "low_stock_signals_per_minute") == {("18:00", "all"): 0.0}


def test_unknown_and_null_types_are_counted(spark):
    metrics = build_metrics(events(spark, event("refund", minute(0)), event(at=minute(0), event_type=None)))
    assert values(metrics, "events_per_minute") == {("18:00", "refund"): 1.0, ("18:00", None): 1.0}
    assert values(metrics, "active_users_per_minute") == {("18:00", "all"): 1.0}


def test_users_all_null_count_zero(spark):
    assert values(build_metrics(events(spark, event(user_id=None))), "active_users_per_minute") == {("18:14", "all"): 0.0}


def test_duplicates_count_twice(spark):
    assert values(build_metrics(events(spark, event(), event())), "events_per_minute") == {("18:14", "page_view"): 2.0}


def test_sliding_windows(spark):
    config = JobConfig(window_duration="5 minutes", slide_duration="1 minute")
    metrics = build_metrics(events(spark, event(at=minute(10, 30))), config)
    starts = {k[0] for k in values(metrics, "events_per_minute")}
    assert starts == {"18:06", "18:07", "18:08", "18:09", "18:10"}


def test_metrics_of_one_dimension_only(spark):
    rows = events(spark, *[event(t) for t in PAYLOADS])
    assert {r.metric_name for r in build_metrics(rows, metrics=named("revenue_per_minute")).collect()} == {
        "revenue_per_minute"}
    assert build_metrics(rows, metrics=named("events_per_minute")).count() == 5


def test_a_metric_of_ones_own(spark):
    carts = M.Metric("cart_value", "scope", (M.Measure("carts", "sum(quantity * unit_price)", "add_to_cart"),),
                     "carts", "carts IS NOT NULL")
    rows = events(spark, event("add_to_cart", minute(0)), event("page_view", minute(1)))
    assert values(build_metrics(rows, metrics=(carts,)), "cart_value") == {("18:00", "all"): pytest.approx(61.25)}


def test_known_answers(spark):
    metrics = metrics_from_records(event_records(read_events(spark, SF_DIR)))
    found = {r.metric_name: (r.n, round(r.total, 2)) for r in metrics.groupBy("metric_name").agg(
        F.count("*").alias("n"), F.sum("metric_value").alias("total")).collect()}
    assert found["events_per_minute"] == (9788, 10000.0)
    assert found["revenue_per_minute"] == (1942, 95455.77)
    assert found["orders_per_minute"] == (1942, 1981.0)
    assert found["payment_success_rate"][0] == 1978
    assert found["active_users_per_minute"][0] == 8961
    assert found["low_stock_signals_per_minute"] == (1965, 216.0)


def test_json_path_equals_flat_path(spark):
    table = read_events(spark, SMALL_DIR)
    decoded, flat = normalize_events(parse_events(event_records(table))), flat_events(table)
    assert decoded.columns == flat.columns
    assert decoded.exceptAll(flat).count() == 0 and flat.exceptAll(decoded).count() == 0


def test_approximate_users_are_near_exact(spark):
    rows = flat_events(read_events(spark, SF_DIR))
    day = JobConfig(window_duration="1 day", slide_duration="1 day")
    near = values_by_day(build_metrics(rows, day, named("active_users_per_minute")))
    exact = values_by_day(build_metrics(rows, day, (M.ACTIVE_USERS_EXACT,)))
    assert near.keys() == exact.keys() and len(exact) == 30
    assert all(abs(near[d] - exact[d]) <= 0.15 * exact[d] for d in exact)


def values_by_day(metrics):
    return {r.window_start: r.metric_value for r in metrics.collect()}


EVENT = st.builds(
    lambda kind, at, user, status, amount, stock: event(
        kind, minute(at // 60, at % 60),
        {"payment_status": status} if kind == "payment_processed" else
        {"total_amount": amount} if kind == "order_created" else
        {"stock_after": stock} if kind == "inventory_updated" else {},
        user_id=user),
    st.sampled_from(EVENT_TYPES), st.integers(0, 179), st.sampled_from(["a", "b", "c", None]),
    st.sampled_from(["approved", "declined", "pending"]), st.integers(0, 500), st.integers(0, 20),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EVENT, min_size=1, max_size=25), st.randoms())
def test_properties(spark, bodies, rng):
    metrics = build_metrics(events(spark, *bodies))
    rows = [tuple(r) for r in metrics.drop("processed_at").collect()]
    by_name = {}
    for start, _, name, value, _, dimension in rows:
        by_name.setdefault(name, {})[(start, dimension)] = value
    assert sum(by_name["events_per_minute"].values()) == len(bodies)
    assert all(0 <= v <= 1 for v in by_name.get("payment_success_rate", {}).values())
    assert by_name.get("revenue_per_minute", {}).keys() == by_name.get("orders_per_minute", {}).keys()
    for (start, _), low in by_name.get("low_stock_signals_per_minute", {}).items():
        assert low <= by_name["events_per_minute"][(start, "inventory_updated")]
    shuffled = list(bodies)
    rng.shuffle(shuffled)
    assert as_set(build_metrics(events(spark, *shuffled)).drop("processed_at")) == set(rows)


def _exact_sliding(spark, config):
    bodies = [event(at=minute(i, 30), user_id=u) for i, u in ((0, "a"), (0, "a"), (2, "a"), (9, "a"), (3, "b"), (4, None))]
    bodies += [event("order_created", minute(i), {"total_amount": 1.5}, user_id="c") for i in (0, 1, 1)]
    return build_metrics(events(spark, *bodies), config, M.METRICS_EXACT)


def test_exact_users_of_overlapping_windows(spark):
    found = _exact_sliding(spark, JobConfig(window_duration="3 minutes", slide_duration="1 minute"))
    users = {k[0]: v for k, v in values(found, "active_users_per_minute").items()}
    assert users == {"17:58": 2.0, "17:59": 2.0, "18:00": 2.0, "18:01": 3.0, "18:02": 2.0, "18:03": 1.0, "18:04": 0.0,
                     "18:07": 1.0, "18:08": 1.0, "18:09": 1.0}
    revenue = {k[0]: v for k, v in values(found, "revenue_per_minute").items()}
    assert revenue == {"17:58": 1.5, "17:59": 4.5, "18:00": 4.5, "18:01": 3.0}


def test_exact_users_of_overlapping_windows_hold_an_event_once(spark):
    """No row is multiplied by its windows before the events are folded to panes."""
    found = _exact_sliding(spark, JobConfig(window_duration="5 minutes", slide_duration="1 minute"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [i for i, line in enumerate(plan) if "Expand" in line]
    folded = [i for i, line in enumerate(plan) if "Aggregate" in line]
    assert len(folded) == 2 and windows and max(windows) < max(folded)


def test_windows_not_made_of_whole_slides_are_counted_exactly(spark):
    found = _exact_sliding(spark, JobConfig(window_duration="3 minutes", slide_duration="2 minutes"))
    users = {k[0]: v for k, v in values(found, "active_users_per_minute").items()}
    assert users["18:00"] == 2.0 and users["18:02"] == 2.0 and users["18:08"] == 1.0
