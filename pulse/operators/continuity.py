"""Stock levels against the previous level of the same product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.columns import is_type


def stock_continuity(events: DataFrame, slice_length: str = "1 minute") -> DataFrame:
    """Each inventory event with the product's previous level and whether the delta explains the new one.

    Events are ordered by producer time (event time where there is none), then id,
    across warehouses. A product's history is cut into slices of that time, so the
    rows one task sorts are bounded by a product's rate and not by the length of the
    table. Within a slice the previous level is a `lag`; the first event of a slice
    takes the last level of the product's previous slice, from a table of one row per
    product and slice. An event that names no product has no previous level.
    """
    moves = events.withColumn("moved_at", F.coalesce("producer_ts", "event_ts")).filter(
        is_type("inventory_updated")
    )
    moves = moves.select(
        "product_id",
        F.window("moved_at", slice_length).start.alias("slice"),
        "moved_at",
        "event_id",
        "warehouse_id",
        "delta_qty",
        "stock_after",
    )
    nameless = moves.filter(F.col("product_id").isNull()).drop("slice").withColumn(
        "previous_stock", F.lit(None).cast("int"))
    moves = moves.filter(F.col("product_id").isNotNull())
    in_slice = Window.partitionBy("product_id", "slice").orderBy("moved_at", "event_id")
    over_slices = Window.partitionBy("product_id").orderBy("slice")

    last_levels = (
        moves.groupBy("product_id", "slice")
        .agg(F.max(F.struct("moved_at", "event_id", "stock_after")).alias("last"))
        .select("product_id", "slice", F.lag("last.stock_after").over(over_slices).alias("carried"))
    )
    lagged = moves.withColumns(
        {"in_slice": F.lag("stock_after").over(in_slice), "position": F.row_number().over(in_slice)}
    )
    previous = F.when(F.col("position") == 1, F.col("carried")).otherwise(F.col("in_slice"))
    # Keyed like the window, so the join needs no further shuffle of the events.
    named = lagged.join(last_levels, ["product_id", "slice"], "left").select(
        "product_id", "moved_at", "event_id", "warehouse_id", "delta_qty", "stock_after", previous.alias("previous_stock"))
    return (
        named.unionByName(nameless)
        .withColumn("is_continuous", F.col("previous_stock") + F.col("delta_qty") == F.col("stock_after"))
    )
