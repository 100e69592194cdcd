"""A table replayed as a stream of several micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a replayed file, give or take what dealing them out differs by.
ROWS_PER_FILE = 50_000


def replay_files(rows: DataFrame, parts: int, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """As many files for each ``__part`` as its rows fill, in order of the parts and with the rows in no order; how many.

    All parts get the number that the largest one fills, so a file stream that takes so many at a time reads part by part, and
    each part in as many tasks. The rows are computed once and lie beside, by part, while they are dealt into files.
    """
    spark, staged = rows.sparkSession, f"{path}-staged"
    rows.filter(F.col("__part").between(0, parts - 1)).write.partitionBy("__part").parquet(staged)
    kept = spark.read.schema(rows.schema).parquet(staged)
    largest = max((r["count"] for r in kept.groupBy("__part").count().collect()), default=0)  # one row per part
    files = max(1, -(-largest // rows_per_file))
    for i in range(parts):
        part = kept.filter(f"__part = {i}").drop("__part")
        part.repartition(files).write.mode("append").parquet(path)
        for _ in range((i + 1) * files - _files(spark, path)):  # a task without rows writes no file
            part.limit(0).repartition(1).write.mode("append").parquet(path)
    return files


def _files(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    return len(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))


def replayed(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """The stream of these files, ``files`` in each micro-batch."""
    # No file is remembered from one listing to the next, which could cut a micro-batch short.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("maxCachedFiles", 0).parquet(path)
