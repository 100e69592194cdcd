"""Payments against the orders they refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.columns import is_type

# What a matched payment must have in common with its order.
COMPARED = {"amount": "order_amount", "currency": "order_currency", "user_id": "order_user_id"}


def order_facts(events: DataFrame) -> DataFrame:
    """One row per order: its first record, so repeated delivery does not multiply matches."""
    first = F.min(F.struct("event_ts", "event_id", "total_amount", "currency", "user_id")).alias("first")
    return (
        events.filter(is_type("order_created") & F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(first)
        .select(
            "order_id",
            F.col("first.event_ts").alias("order_ts"),
            F.col("first.total_amount").alias("order_amount"),
            F.col("first.currency").alias("order_currency"),
            F.col("first.user_id").alias("order_user_id"),
        )
    )


def payment_facts(events: DataFrame) -> DataFrame:
    return events.filter(is_type("payment_processed")).select(
        "event_id", "event_ts", "payment_id", "order_id", "payment_status", "amount", "currency", "user_id"
    )


def reconcile_payments(events: DataFrame) -> DataFrame:
    """Every payment with its order, if any, and how the two compare.

    Orders are one row per id, so a much-referenced order is large on the payments' side
    only, which adaptive execution splits. Two reads of the events, one for each side.
    ``status`` is ``orphan`` (no such order), ``match`` or ``mismatch``;
    ``differences`` names what differs.
    """
    return compare_with_order(payment_facts(events).join(order_facts(events), "order_id", "left"))


def compare_with_order(joined: DataFrame) -> DataFrame:
    orphan = F.col("order_ts").isNull()
    differing = F.concat_ws(
        ",", *[F.when(~F.col(ours).eqNullSafe(F.col(theirs)), ours) for ours, theirs in COMPARED.items()]
    )
    return joined.withColumn("differences", F.when(~orphan, differing)).withColumn(
        "status", F.when(orphan, "orphan").otherwise(_verdict(F.col("differences")))
    )


def _verdict(differences: Column) -> Column:
    return F.when(differences == "", "match").otherwise("mismatch")


def payment_orphans(events: DataFrame) -> DataFrame:
    """Payments whose order was never seen."""
    return reconcile_payments(events).filter("status = 'orphan'").select(payment_facts(events).columns)


def payment_matches(events: DataFrame) -> DataFrame:
    """Payments whose order exists, with the comparison."""
    return compare_with_order(payment_facts(events).join(order_facts(events), "order_id"))
