"""The metric table: day partitions, sorted files, replay-safe streaming writes.

Layout: ``<path>/window_date=<day>/run_id=<run>/batch_id=<n>``, days in UTC. A batch load is
a run with the batch id 0; a stream's run is its query. A replayed micro-batch replaces
the directories of its own id; a query with a new checkpoint has another run id and
so never overwrites an older run. Readers see the last processed version of a window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from pulse.contract import METRIC_COLUMNS, METRIC_SCHEMA
from pulse.functions.columns import between_instants, utc_day

SORT_KEY = ("metric_name", "window_start", "dimension_key", "dimension_value")
PARTITIONS = ("window_date", "run_id", "batch_id")
TABLE_SCHEMA = StructType([*METRIC_SCHEMA.fields, StructField("window_date", DateType()),
                           StructField("run_id", StringType()), StructField("batch_id", LongType())])
#: Rows of a streamed file at most, give or take what ranges differ by.
ROWS_PER_FILE = 1_000_000
BATCH_RUN, COMPACTED_RUN = "load", "compacted"

BatchWriter = Callable[[DataFrame, int], None]


def table_rows(metrics: DataFrame) -> DataFrame:
    """The table's columns in order; a missing value counts as 0."""
    value = F.coalesce("metric_value", F.lit(0.0)).alias("metric_value")
    return metrics.select(*[value if name == "metric_value" else name for name in METRIC_COLUMNS])


def write_metric_table(metrics: DataFrame, path: str, mode: str = "overwrite", run_id: str = BATCH_RUN) -> None:
    """Batch load. Overwriting replaces the run's days that occur in the rows, no others."""
    dated = table_rows(metrics).withColumns(
        {"window_date": utc_day(F.col("window_start")), "run_id": F.lit(run_id), "batch_id": F.lit(0)})
    (
        # Rebalancing gives a day few files of proper size and splits a day that is too large.
        dated.hint("rebalance", "window_date")
        .sortWithinPartitions("window_date", *SORT_KEY)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def metric_batch_writer(path: str, rows_per_file: int = ROWS_PER_FILE) -> BatchWriter:
    """`foreachBatch` writer into the table; an empty batch writes no partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(table_rows(batch), path, batch_id, SORT_KEY, rows_per_file)

    return write


def write_batch(rows: DataFrame, path: str, batch_id: int, sort_key: Sequence[str], rows_per_file: int) -> None:
    """Rows of a micro-batch as the directories of its query and batch id.

    A stateful stream plans without adaptive execution, so the number of tasks follows from the number of
    rows: they are dealt by range of day and sort key, a small batch to one task, a backlog, even of a single day, to as many
    as it fills. The rows are kept for the count and the write; what is lost of them is computed again.
    """
    run_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if run_id is None:
        raise RuntimeError("the table writer has to run inside a streaming query")
    dated = rows.withColumns(
        {"window_date": utc_day(F.col("window_start")), "run_id": F.lit(run_id), "batch_id": F.lit(batch_id)}).persist()
    try:
        files = max(1, -(-dated.count() // rows_per_file))
        (
            dated.repartitionByRange(files, "window_date", *sort_key)
            .sortWithinPartitions("window_date", *sort_key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS)
            .parquet(path)
        )
    finally:
        dated.unpersist()


def jdbc_batch_writer(options: Mapping[str, str], num_partitions: int = 4) -> BatchWriter:
    """`foreachBatch` writer into an external OLAP table, from the executors.

    ``num_partitions`` is how many connections the server is to have at once.
    At-least-once: a replayed batch is appended again. The JDBC driver has to be on
    the class path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = table_rows(batch).repartition(num_partitions)
        rows.write.format("jdbc").options(**dict(options)).mode("append").save()

    return write


def read_metric_table(
    spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None, every_version: bool = False
) -> DataFrame:
    """The table, or its windows starting within [start, end], each in its last version.

    A range reads the directories of its UTC days only. A path that does not exist is an error
    for any range.
    """
    rows = spark.read.schema(TABLE_SCHEMA).option("basePath", path).parquet(path)
    ranged = between_instants(rows, start, end)
    if every_version:
        return ranged.select(*METRIC_COLUMNS, *PARTITIONS)
    latest = latest_version(ranged)
    return latest.withColumn("window_date", utc_day(F.col("window_start")))


def latest_version(metrics: DataFrame) -> DataFrame:
    """One row per window and series, the last processed and of equal times the largest value.

    For rows of several runs or batches.
    """
    key = ["window_start", "window_end", "metric_name", "dimension_key", "dimension_value"]
    return metrics.groupBy(*key).agg(
        F.max_by("metric_value", F.struct("processed_at", "metric_value")).alias("metric_value"),
        F.max("processed_at").alias("processed_at"),
    ).select(*METRIC_COLUMNS)


def compact_metric_table(spark: SparkSession, path: str, before: date) -> int:
    """Put the runs and batches of every UTC day before ``before`` into one run; the number of days.

    For days that are closed: nobody may write to them meanwhile. The compacted rows are
    written first and the other runs removed then, so a reader sees every window at any
    time, and a compaction that was interrupted is finished by the next one.
    """
    rows = spark.read.schema(TABLE_SCHEMA).option("basePath", path).parquet(path).filter(F.col("window_date") < F.lit(before))
    parts = rows.select(*PARTITIONS).distinct()
    old = [r for r in parts.collect() if r["run_id"] != COMPACTED_RUN]  # directories of the table, not rows
    days = sorted({r["window_date"] for r in old})
    if not days:
        return 0
    latest = latest_version(rows.filter(F.col("window_date").isin(*days)))
    # What is read may lie in the directories that are replaced, hence the new batch id.
    batches = parts.filter(F.col("run_id") == COMPACTED_RUN).agg(F.max("batch_id")).first()[0]
    dated = latest.withColumns({"window_date": utc_day(F.col("window_start")), "run_id": F.lit(COMPACTED_RUN),
                                "batch_id": F.lit(0 if batches is None else batches + 1)})
    dated.hint("rebalance", "window_date").sortWithinPartitions("window_date", *SORT_KEY).write.mode("append").partitionBy(
        *PARTITIONS).parquet(path)
    compacted = [r for r in parts.filter(F.col("window_date").isin(*days)).collect()
                 if r["run_id"] != COMPACTED_RUN or r["batch_id"] <= (-1 if batches is None else batches)]
    for r in compacted:
        _remove(spark, f"{path}/window_date={r['window_date']}/run_id={r['run_id']}/batch_id={r['batch_id']}")
    return len(days)


def _remove(spark: SparkSession, directory: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(directory)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
