"""Column expressions shared by the operators. All of them are Spark built-ins."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_content(value: Column) -> Column:
    """False for a null value and for one of JSON white space only.

    These are the inputs for which `from_json` gives no struct at all; malformed
    text gives a struct of nulls instead.
    """
    return F.length(F.btrim(value.cast("string"), F.lit(" \t\r\n"))) > 0


def once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Append a column whose expression is evaluated exactly once per row.

    Predicates on an ordinary projected column are pushed below the projection and
    take a copy of the expression along. The optimizer does not push through a
    generator's output, so a costly decode placed in one is not repeated.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))


def event_timestamp(text: Column) -> Column:
    """ISO-8601 text to an instant; text that is no timestamp gives null, not an error."""
    return F.try_to_timestamp(text)


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def iso_utc(ts: Column) -> Column:
    """Instant to ISO-8601 text with a UTC offset; microseconds only where there are some."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def event_identity() -> Column:
    """The event id; a record without one is identified by its place in the broker.

    Null for a record that has neither, as one read from files: it is like no other record.
    """
    place = F.concat_ws("/", F.lit("record"), "kafka_topic", "kafka_partition", "kafka_offset")
    placed = F.when(F.col("kafka_offset").isNotNull(), place)
    return F.coalesce(F.concat(F.lit("event/"), F.col("event_id")), placed)


def as_utc(moment: datetime) -> datetime:
    """A naive datetime is taken as UTC."""
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def instant(moment: datetime) -> Column:
    """Timestamp literal that does not depend on the zone of the host."""
    since_epoch = as_utc(moment) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (since_epoch.days * 86400 + since_epoch.seconds) * 1_000_000 + since_epoch.microseconds
    return F.timestamp_micros(F.lit(micros))


def utc_day(ts: Column) -> Column:
    """The day in UTC, whatever the zone of the session."""
    return F.to_date(F.to_utc_timestamp(ts, F.current_timezone()))


def between_instants(metrics: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Windows starting within [start, end]; a day partition, which is in UTC, is narrowed along with it."""
    dated = "window_date" in metrics.columns
    if start is not None:
        metrics = metrics.filter(F.col("window_start") >= instant(start))
        metrics = metrics.filter(F.col("window_date") >= F.lit(as_utc(start).date())) if dated else metrics
    if end is not None:
        metrics = metrics.filter(F.col("window_start") <= instant(end))
        metrics = metrics.filter(F.col("window_date") <= F.lit(as_utc(end).date())) if dated else metrics
    return metrics
