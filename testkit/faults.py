"""Contract violations planted in the test events, by a fixed rule on the event id.

Every event of the table is still present; some of them carry one fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from testkit.adapter import event_fields, json_value
from pulse.functions.columns import once

# Event id modulo PERIOD -> fault.
PERIOD = 40
FAULTS = {
    0: "truncated",
    1: "without_user",
    2: "unknown_type",
    3: "extra_key",
    4: "other_payload",
    5: "negative_money",
    6: "empty_session",
    7: "bad_time",
    8: "numeric_source",
    9: "extra_payload_key",
    10: "empty_text",
    11: "array_text",
    12: "null_referrer",
    13: "payload_text",
    14: "far_integer",
    15: "trailing_text",
    16: "two_documents",
    17: "whole_decimal",
    18: "infinite_number",
    19: "missing_field",
    20: "negative_stock",
    21: "two_faults",
    22: "repeated_key",
}


def faulty_values(events: DataFrame) -> DataFrame:
    """(event_id, event_type, value) with the JSON text of each event, faults applied."""
    fields = event_fields(events)
    number = F.col("event_id").cast("bigint") % PERIOD
    faults = F.create_map(*[F.lit(x) for pair in FAULTS.items() for x in pair])
    marked = fields.withColumn("fault", F.try_element_at(faults, number.cast("int")))

    def on(name: str, replacement: Column, field: str) -> Column:
        return F.when(F.col("fault") == name, replacement).otherwise(F.col(field))

    def negated(field: str) -> Column:
        return on("negative_money", -1 - F.col(field), field)

    changed = marked.withColumns(
        {
            "user_id": F.when(F.col("fault") == "without_user", None).otherwise(F.col("user_id")),
            "event_type": on("unknown_type", F.lit("refund"), "event_type"),
            "session_id": F.when(F.col("fault").isin("empty_session", "two_faults"), "").otherwise(F.col("session_id")),
            "product_id": F.when(F.col("fault") != "missing_field", F.col("product_id")).when(
                F.col("fault").isNull(), F.col("product_id")),
            "stock_after": on("negative_stock", -F.col("stock_after") - 1, "stock_after"),
            "event_time": on("bad_time", F.lit("yesterday"), "event_time"),
            "unit_price": negated("unit_price"),
            "total_amount": negated("total_amount"),
            "amount": negated("amount"),
            "warehouse_id": F.when(
                (F.col("fault") == "other_payload") & (F.col("event_type") != "inventory_updated"), "wh_09"
            ).otherwise(F.col("warehouse_id")),
        }
    )
    texted = once(changed, "json", json_value())
    text = F.col("json")
    fault = F.col("fault")
    value = (
        F.when(fault == "truncated", F.substring(text, 1, 60))
        .when(fault.isin("extra_key", "two_faults"), F.concat(F.lit('{"extra":1,'), F.expr("substring(json, 2)")))
        .when(fault == "numeric_source", F.replace(text, F.lit('"source":"testdata"'), F.lit('"source":7')))
        .when(fault == "extra_payload_key", F.replace(text, F.lit('"payload":{'), F.lit('"payload":{"note":"x",')))
        .when(fault == "empty_text", F.lit(" "))
        .when(fault == "array_text", F.concat(F.lit("["), text, F.lit("]")))
        .when(fault == "null_referrer", F.replace(text, F.lit('"referrer":"direct"'), F.lit('"referrer":null')))
        .when(fault == "payload_text", F.regexp_replace(text, r'"payload":\{.*\}\}$', '"payload":"none"}'))
        .when(fault == "far_integer", F.regexp_replace(text, r'"(quantity|items_count|stock_after)":\d+', '"$1":99999999999'))
        .when(fault == "trailing_text", F.concat(text, F.lit(" and more")))
        .when(fault == "two_documents", F.concat(text, text))
        .when(fault == "whole_decimal", F.regexp_replace(text, r'"(quantity|items_count|stock_after)":(\d+)', '"$1":$2.0'))
        .when(fault == "infinite_number", F.regexp_replace(text, r'"(unit_price|total_amount|amount)":[0-9.E-]+', '"$1":1e400'))
        .when(fault == "repeated_key", F.replace(text, F.lit('"source":"testdata"'), F.lit('"source":"x","source":"testdata"')))
        .otherwise(text)
    )
    return texted.select("event_id", "event_type", value.alias("value"))


def faulty_records(events: DataFrame) -> DataFrame:
    return faulty_values(events).select(
        F.col("event_id").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("events.raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("event_id").cast("bigint") * 60).alias("timestamp"),
    )


