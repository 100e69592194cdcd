"""Folders for the queries that write before they read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared one, or below the warehouse where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
