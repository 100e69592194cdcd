"""The table of window sketches: the metric table's layout, so that a replayed micro-batch replaces its own rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.columns import between_instants, utc_day
from pulse.operators.sketches import SKETCH_COLUMNS
from pulse.sinks.metric_table import BATCH_RUN, PARTITIONS, BatchWriter, write_batch

SCHEMA = ("window_start timestamp, window_end timestamp, n_events long, users_sketch binary, lag_sketch binary, "
          "processed_at timestamp, window_date date, run_id string, batch_id long")


def _stamped(sketches: DataFrame) -> DataFrame:
    return sketches.select(*SKETCH_COLUMNS, F.current_timestamp().alias("processed_at"))


def write_sketch_table(sketches: DataFrame, path: str, run_id: str = BATCH_RUN) -> None:
    """Batch load; the run's days that occur in the rows are replaced."""
    dated = _stamped(sketches).withColumns({"window_date": utc_day(F.col("window_start")), "run_id": F.lit(run_id), "batch_id": F.lit(0)})
    (dated.hint("rebalance", "window_date").sortWithinPartitions("window_date", "window_start")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))


def sketch_batch_writer(path: str, rows_per_file: int = 50_000) -> BatchWriter:
    """`foreachBatch` writer of a stream of `window_sketches`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(_stamped(batch), path, batch_id, ("window_start",), rows_per_file)

    return write


def read_sketch_table(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Windows starting within [start, end], each as it was last processed; reads the range's days only."""
    ranged = between_instants(spark.read.schema(SCHEMA).option("basePath", path).parquet(path), start, end)
    names = ("n_events", "users_sketch", "lag_sketch")
    latest = F.max_by(F.struct(*names), F.struct("processed_at", "n_events", "run_id", "batch_id")).alias("last")
    return ranged.groupBy("window_start", "window_end").agg(latest).select("window_start", "window_end", *(f"last.{n}" for n in names))
