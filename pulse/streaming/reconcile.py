"""Payments against orders while both are still streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.functions.columns import is_type
from pulse.operators.reconcile import compare_with_order, payment_facts


def dealt(payments: DataFrame, pieces: int) -> DataFrame:
    """Payments with the ``piece`` of their order's key; without an order nothing is met, so any number will do."""
    content = F.xxhash64(*payments.columns)
    by_event = F.pmod(F.xxhash64("event_id"), F.lit(pieces))
    return payments.withColumn("piece", F.when(F.col("order_id").isNull(), content).otherwise(by_event))


def reconcile_payment_stream(
    payment_events: DataFrame,
    order_events: DataFrame,
    before: str = "1 hour",
    after: str = "1 minute",
    pieces: int = 1,
) -> DataFrame:
    """Payments with their order, matches at once, orphans when their time is over.

    Both sides are streams from `normalize_events`, normalised separately even if
    they read the same topic: two branches of one stream would share one watermark
    node, and Spark would keep the mark of either branch instead of the lower one.
    The watermark then follows the slower of orders and payments; other events do
    not move it, as the filters on event type run below it.

    An order belongs to a payment if it happened at most ``before`` earlier or
    ``after`` later (both times lag independently); the bound on both sides lets
    Spark drop state. A payment without an order comes out once the watermark has
    passed its bound. Of an order that is delivered again within the watermark delay the
    first counts. Where single orders are known to have very many payments, ``pieces`` deals
    these over several tasks, at the price of as many copies of every order in state.
    Payments that name no order wait like the others, dealt by their content, so many
    of them are not one key of the state.
    """
    payments = dealt(payment_facts(payment_events), pieces)
    created = order_events.filter(is_type("order_created") & F.col("order_id").isNotNull())
    orders = created.dropDuplicatesWithinWatermark(["order_id"]).select(
        F.col("order_id").alias("order_key"),
        F.col("event_ts").alias("order_ts"),
        F.col("total_amount").alias("order_amount"),
        F.col("currency").alias("order_currency"),
        F.col("user_id").alias("order_user_id"),
        F.explode(F.expr(f"sequence(0L, {pieces - 1}L)")).alias("order_piece"),
    )
    belongs = (
        (F.col("order_id") == F.col("order_key"))
        & (F.col("piece") == F.col("order_piece"))
        & (F.col("order_ts") >= F.col("event_ts") - F.expr(f"INTERVAL {before}"))
        & (F.col("order_ts") <= F.col("event_ts") + F.expr(f"INTERVAL {after}"))
    )
    joined = payments.join(orders, belongs, "left").drop("piece", "order_piece", "order_key")
    return compare_with_order(joined)
