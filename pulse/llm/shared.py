"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pulse-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_workspaces: list[str] = []


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Tables written within, except those to be kept, are removed at its end.

    For the part of an operator that runs at once: what it returns may read kept tables only.
    """
    folder = f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"
    _workspaces.append(folder)
    try:
        yield
    finally:
        _workspaces.pop()
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str, keep: bool = False, rows_per_file: int = 1_000_000) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here and a lost executor costs nothing.

    Outside a workspace, or with ``keep``, the files stay, as the result may be read at
    any later time; the folder's owner clears it.
    """
    root = shared_folder(df.sparkSession) if keep or not _workspaces else _workspaces[-1]
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(table: DataFrame, group: str, name: str) -> DataFrame:
    """Append gapless numbers from 0 within each group to a table that lies in files.

    A row's number is the count of its group's rows in earlier files plus its rank in
    its own file, so a group of any size is numbered by as many tasks as it has files.
    """
    from pyspark.sql import Window

    place = table.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    in_file = place.withColumn(
        "__rank", F.row_number().over(Window.partitionBy("__file", group).orderBy("__row")) - F.lit(1)
    )
    counts = place.groupBy("__file", group).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(group).orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__file", group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    joined = in_file.join(before, ["__file", group])
    return joined.withColumn(name, (F.col("__before") + F.col("__rank")).cast("long")).drop(
        "__file", "__row", "__rank", "__before"
    )


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
