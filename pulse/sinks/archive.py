"""Checked events as a partitioned archive: valid events and rejects in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pulse.contract import EVENT_TYPES
from pulse.functions.columns import event_timestamp, utc_day

PARTITIONS = ("verdict", "event_type_key", "event_date")


def archive_rows(checked: DataFrame) -> DataFrame:
    """Output of `check_contract` with the partition columns.

    The raw text is kept on all. Valid events lie under their type and UTC day. Rejects, whose
    own claims may be anything, lie under ``unknown`` unless they name a type of the
    contract, and under the day the broker received them.
    """
    named = F.col("event_type").isin(*EVENT_TYPES)
    return checked.withColumns(
        {
            "verdict": F.when(F.col("is_valid"), "valid").otherwise("rejected"),
            "event_type_key": F.when(named, F.col("event_type")).otherwise("unknown"),
            "event_date": utc_day(F.when(F.col("is_valid"), event_timestamp(F.col("event_time"))).otherwise(
                F.col("kafka_timestamp"))),
        }
    )


def write_archive(checked: DataFrame, path: str, mode: str = "append") -> None:
    rows = archive_rows(checked).hint("rebalance", *PARTITIONS)
    rows.write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def archive_writer(checked: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Streaming archive by the file sink, whose commit log makes it exactly-once."""
    # Rebalancing gives a partition few files of proper size and a backlog of one day as many tasks as it fills.
    rows = archive_rows(checked).hint("rebalance", *PARTITIONS)
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
