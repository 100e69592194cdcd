"""Event time, numeric defaults and signal flags on flat events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.functions.columns import event_timestamp, flag, is_type

# Fixed value: stock from 1 up to this level is a low-stock signal.
LOW_STOCK_LEVEL = 10

# Numeric payload columns and what an absent value counts as.
NUMERIC_DEFAULTS = {
    "quantity": 0,
    "unit_price": 0.0,
    "items_count": 0,
    "total_amount": 0.0,
    "amount": 0.0,
    "delta_qty": 0,
    "stock_after": 0,
}


def signal_flags() -> dict[str, Column]:
    """Signals read from one event; they expect the numeric defaults to be in place."""
    payment = is_type("payment_processed")
    return {
        "payment_approved_flag": flag(payment & (F.col("payment_status") == "approved")),
        "payment_attempt_flag": flag(payment),
        "low_stock_flag": flag(is_type("inventory_updated") & F.col("stock_after").between(1, LOW_STOCK_LEVEL)),
        "order_event_flag": flag(is_type("order_created")),
        "page_view_flag": flag(is_type("page_view")),
        "active_user_flag": F.col("user_id"),
    }


def normalize_events(events: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Parse times, fill numeric gaps, derive flags, drop events without a time, set the watermark."""
    present = set(events.columns)
    times = {"event_ts": "event_time", "producer_ts": "producer_time"}
    derived = {ts: event_timestamp(F.col(text)) for ts, text in times.items() if text in present}
    derived |= {n: F.coalesce(F.col(n), F.lit(v)) for n, v in NUMERIC_DEFAULTS.items() if n in present}
    usable = events.withColumns(derived).withColumns(signal_flags()).filter(F.col("event_ts").isNotNull())
    if config.max_event_skew is not None:
        usable = drop_future_events(usable, config.max_event_skew)
    return usable.withWatermark("event_ts", config.watermark_delay)


def drop_future_events(events: DataFrame, max_skew: str) -> DataFrame:
    """Drop events dated further ahead of their broker time than ``max_skew``.

    One such event would move the watermark for everybody. Records without a
    broker time (files) are kept.
    """
    limit = F.col("kafka_timestamp") + F.expr(f"INTERVAL {max_skew}")
    return events.filter(F.col("kafka_timestamp").isNull() | (F.col("event_ts") <= limit))
