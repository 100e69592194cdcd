"""Duplicates dropped however late they come: a ledger of all identities, by day, instead of streaming state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pulse.functions.columns import event_identity, utc_day
from pulse.operators.monitor import dedup_events
from pulse.sinks.metric_table import BatchWriter

NEW, REPEATED, UNJUDGED = "new", "repeated", "unjudged"
#: Days between an event and its arrival for which identities are remembered.
RETENTION_DAYS = 35
LEDGER = "id_high long, id_low long, event_day date, batch_id long"
COMPACTED = -1


def ledger_writer(path: str, retention_days: int = RETENTION_DAYS) -> BatchWriter:
    """`foreachBatch` writer of normalised events: ``<path>/events/batch_id=<n>/verdict=<new|unjudged>``.

    A copy has its event's time, so it can only be in the ledger under its day:
    ``<path>/ledger/event_day=<day>/batch_id=<n>`` holds 128-bit names of the identities first seen in a batch. Of these
    days, rows that a batch cannot match are dropped while they are read, by the Bloom filter Spark makes of the batch's
    names, and only matches reach the join with the events. Copies within a batch go first. Events without any identity are like no other and stay.
    An event that arrives after its day's identities may be forgotten is neither accepted nor dropped but set
    aside. A replayed batch leaves out what it wrote itself before and replaces it, so nothing is lost or repeated.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = batch.columns
        once = dedup_events(batch)
        identity, day = event_identity(), utc_day(F.col("event_ts"))
        old = F.datediff(utc_day(F.col("kafka_timestamp")), day) > retention_days
        named = once.withColumns({
            "id_high": F.xxhash64(identity), "id_low": F.xxhash64(F.lit(1), identity), "event_day": day,
            "verdict": F.when(F.coalesce(old, F.lit(False)) & identity.isNotNull(), UNJUDGED).otherwise(NEW),
            "named": identity.isNotNull()}).persist()
        try:
            key = ["event_day", "id_high", "id_low"]
            judged = named.filter("named").filter(F.col("verdict") == NEW).select(*key)
            seen = _ledger(spark, path).filter(F.col("batch_id") < batch_id).join(judged, key, "left_semi").select(*key).distinct()
            is_seen = seen.withColumn("seen", F.lit(True))
            kept = named.join(is_seen, key, "left").filter(F.col("seen").isNull())
            kept.select(*names, "verdict").write.mode("overwrite").partitionBy("verdict").parquet(f"{path}/events/batch_id={batch_id}")
            (kept.filter("named").filter(F.col("verdict") == NEW).select(*key, F.lit(batch_id).alias("batch_id"))
             .repartition("event_day").sortWithinPartitions("event_day", "id_high")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_day", "batch_id").parquet(f"{path}/ledger"))
        finally:
            named.unpersist()

    return write


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ledger")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", f"{path}/ledger").parquet(f"{path}/ledger")


def unique_events(spark: SparkSession, path: str, schema: StructType, verdict: str = NEW) -> DataFrame:
    """Events of this schema that were accepted, or those set aside."""
    places = [StructField("verdict", StringType()), StructField("batch_id", LongType())]
    rows = spark.read.schema(StructType([*schema.fields, *places])).option("basePath", f"{path}/events").parquet(f"{path}/events")
    return rows.filter(F.col("verdict") == verdict).drop("verdict", "batch_id")


def forget(spark: SparkSession, path: str, before: date, compact_before: date | None = None) -> None:
    """Remove the identities of days before ``before`` and put the files of each day before ``compact_before`` together.

    For days whose batches are committed and to which nobody writes meanwhile. Compacted rows are written
    before the others go; identities that stand there twice after an interruption do no harm.
    """
    ledger = _ledger(spark, path)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(f"{path}/ledger").getFileSystem(spark._jsc.hadoopConfiguration())
    # One entry per day in the folder of the ledger, which retention bounds; each read here is of a folder's name.
    days = sorted(r[0] for r in ledger.select("event_day").distinct().collect())
    for day in (d for d in days if d < before):
        files.delete(fs_path(f"{path}/ledger/event_day={day}"), True)
    for day in (d for d in days if before <= d < (compact_before or before)):
        folder = fs_path(f"{path}/ledger/event_day={day}")
        own = [status.getPath() for status in files.listStatus(folder)]
        new = [p for p in own if p.getName() != f"batch_id={COMPACTED}"]
        if not new:
            continue
        rows = ledger.filter(F.col("event_day") == F.lit(day)).select("id_high", "id_low").distinct()
        staged = fs_path(f"{path}/compacting-{day}")
        rows.repartitionByRange("id_high").sortWithinPartitions("id_high").write.mode("overwrite").parquet(staged.toString())
        target = fs_path(f"{folder.toString()}/batch_id={COMPACTED}")
        parts = [s.getPath() for s in files.listStatus(staged) if s.getPath().getName().startswith("part-")]
        files.mkdirs(target)
        for part in parts:
            files.rename(part, fs_path(f"{target.toString()}/{part.getName()}"))
        kept = {part.getName() for part in parts}
        for status in files.listStatus(target):
            if status.getPath().getName() not in kept:
                files.delete(status.getPath(), False)
        for folder_of_batch in new:
            files.delete(folder_of_batch, True)
        files.delete(staged, True)
