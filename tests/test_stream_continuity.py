"""Stock continuity on a stream against the batch operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from builders import event
from pulse.operators.continuity import stock_continuity
from pulse.operators.normalize import normalize_events
from pulse.operators.parse import parse_events
from pulse.sources.records import read_records
from pulse.streaming.continuity import stock_continuity_stream
from test_streaming import Replay, replay  # noqa: F401


def move(event_id, at, delta, stock, product="item-1", produced=None, **changes):
    payload = {"product_id": product, "delta_qty": delta, "stock_after": stock, "warehouse_id": "w"}
    return event("inventory_updated", f"2026-03-07T{at}Z", payload, event_id=event_id,
                 producer_time=f"2026-03-07T{produced or at}Z", **changes)


def test_out_of_order_moves_give_the_batch_result(spark, replay: Replay):  # noqa: F811
    stream = stock_continuity_stream(normalize_events(parse_events(replay.source())))
    out = str(replay.root / "out")

    def step(*moves):
        replay.add_events(*moves)
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(replay.root / "c"))
         .trigger(availableNow=True).start().awaitTermination())
        rows = spark.read.parquet(out).select("event_id", "previous_stock", "is_continuous").collect()
        assert len(rows) == len({r[0] for r in rows})
        return {r[0]: (r[1], r[2]) for r in rows}

    first = step(move("b", "18:00:05", -5, 10), move("a", "18:00:03", -5, 15), move("p", "18:00:04", 1, 3, "item-2"),
                 move("none", "18:00:02", 1, 3, None))
    assert first == {"none": (None, None)}  # no product, nothing to wait for
    # Two more for open time, one of a later second id at an equal time, one whose time is a tie.
    assert step(move("0", "18:00:01", 2, 20), move("bb", "18:00:05", 1, 12), move("q", "18:01:55", -1, 2, "item-2")) == first
    closed = step(move("x", "18:05:00", -2, 10), move("y", "18:05:00", -2, 8, "item-2"))
    assert closed == first | {"0": (None, None), "a": (20, True), "b": (15, True), "bb": (10, False), "p": (None, None), "q": (3, True)}
    # A clock that is behind: the event is in time, its move belongs before one that came out.
    late = step(move("late", "18:05:10", -1, 9, produced="18:00:00"), move("z", "18:20:00", 0, 10))
    assert late == closed | {"late": (None, None)} | {"x": (12, True), "y": (2, False)}
    batch = stock_continuity(normalize_events(parse_events(read_records(spark, str(replay.root / "in")))))
    known = {r["event_id"]: (r["previous_stock"], r["is_continuous"]) for r in batch.collect()}
    assert all(known[name] == found for name, found in closed.items() if name != "0")  # "late" is first in the batch


def test_the_state_is_released(spark, replay: Replay):  # noqa: F811
    stream = stock_continuity_stream(normalize_events(parse_events(replay.source())), slice_seconds=60)
    for minute in range(0, 40, 10):
        replay.add_events(*[move(f"{minute}-{i}", f"18:{minute + i // 6:02d}:{i % 6 * 10:02d}", 1, i, f"item-{i % 3}") for i in range(12)])
    query = (stream.writeStream.format("memory").queryName("released").option("checkpointLocation", str(replay.root / "c"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.table("released").groupBy("product_id").agg(F.count("*"), F.count("previous_stock")).collect()
    assert sum(r[1] for r in rows) == 36 and all(r[1] == r[2] + 1 for r in rows)
