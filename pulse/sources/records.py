"""Bounded and replay sources: the same records from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pulse.contract import RECORD_SCHEMA
from pulse.operators.parse import with_broker_columns


def read_records(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    streaming: bool = False,
    schema: StructType = RECORD_SCHEMA,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Records from parquet, orc or avro files with broker columns, or from text with one JSON value per line."""
    reader = (spark.readStream if streaming else spark.read).format(file_format).options(**options)
    if file_format != "text":
        reader = reader.schema(schema)
    if streaming and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_broker_columns(reader.load(path))
