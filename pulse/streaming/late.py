"""Events behind the watermark: set aside and counted instead of dropped unseen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pulse.config import JobConfig
from pulse.functions.columns import once
from pulse.sinks.metric_table import BatchWriter

ON_TIME, LATE = "on_time", "late"
LEDGER_SCHEMA = "n_on_time long, n_late long, seen_ms long, batch_id long"


def last_window_end(config: JobConfig) -> Column:
    """End of the last window that an event belongs to."""
    return F.window("event_ts", config.slide_duration).start + F.expr(f"INTERVAL {config.window_duration}")


def late_router(path: str, config: JobConfig = JobConfig()) -> BatchWriter:
    """`foreachBatch` writer for a stream of normalised events: ``<path>/events/batch_id=<n>/verdict=<on_time|late>``.

    An event is late if its last window had ended by the watermark of the batches before its own: the greatest event time
    they saw, less the configured delay. That mark is not Spark's internal one but kept in a ledger,
    ``<path>/ledger/batch_id=<n>``, one row per batch with the counts of both verdicts, observed while the batch
    is written. A replayed batch finds the same mark and replaces its own folders, so a restart
    neither loses nor repeats an event. Each row holds the greatest time seen so far, so a batch reads one row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen_before(spark, path, batch_id)
        late = F.lit(False)
        if seen is not None:
            mark = F.timestamp_millis(F.lit(seen)) - F.expr(f"INTERVAL {config.watermark_delay}")
            late = F.coalesce(last_window_end(config) <= mark, F.lit(False))
        observed = Observation()
        judged = once(batch, "verdict", F.when(late, LATE).otherwise(ON_TIME)).observe(
            observed, F.count_if(F.col("verdict") == ON_TIME).alias("on_time"), F.count_if(F.col("verdict") == LATE).alias("late"),
            F.max(F.unix_millis("event_ts")).alias("seen"))
        judged.write.mode("overwrite").partitionBy("verdict").parquet(f"{path}/events/batch_id={batch_id}")
        found = observed.get
        times = [t for t in (seen, found["seen"]) if t is not None]
        row = [(found["on_time"] or 0, found["late"] or 0, max(times, default=None))]
        fields = LEDGER_SCHEMA.rsplit(", ", 1)[0]
        spark.createDataFrame(row, fields).coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/batch_id={batch_id}")

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _seen_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Greatest event time of all earlier batches: in the row of the one before."""
    if batch_id == 0:
        return None
    if not _exists(spark, f"{path}/ledger/batch_id={batch_id - 1}/_SUCCESS"):
        raise RuntimeError(f"the ledger in {path} has no batch {batch_id - 1}: it belongs to another checkpoint")
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/ledger/batch_id={batch_id - 1}").first()["seen_ms"]


def lateness(spark: SparkSession, path: str, config: JobConfig = JobConfig()) -> DataFrame:
    """The ledger: events on time and late in each batch, and the watermark that the batch was judged by."""
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/ledger")
    before = rows.select((F.col("batch_id") + 1).alias("batch_id"), F.timestamp_millis("seen_ms").alias("seen"))
    mark = (F.col("seen") - F.expr(f"INTERVAL {config.watermark_delay}")).alias("watermark")
    return rows.join(before, "batch_id", "left").select("batch_id", "n_on_time", "n_late", mark)


def routed_events(spark: SparkSession, path: str, schema: StructType, verdict: str | None = None) -> DataFrame:
    """All events of this schema that went through the router, or those of one verdict, which reads only their folders."""
    places = [StructField("verdict", StringType()), StructField("batch_id", LongType())]
    rows = spark.read.schema(StructType([*schema.fields, *places])).option("basePath", f"{path}/events").parquet(f"{path}/events")
    return rows if verdict is None else rows.filter(F.col("verdict") == verdict)
