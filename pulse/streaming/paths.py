"""Where a job keeps its checkpoints."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pulse.config import JobConfig


def shared_root(spark: SparkSession, config: JobConfig = JobConfig()) -> str:
    """The configured folder, else the one the cluster names in ``spark.checkpoint.dir``.

    There is no machine-local fallback: state that other executors cannot read is
    lost with its host.
    """
    root = config.checkpoint_dir or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set checkpoint_dir, or spark.checkpoint.dir on the session, to a shared folder")
    return root.rstrip("/")


def checkpoint_location(spark: SparkSession, config: JobConfig, name: str | None = None) -> str:
    return f"{shared_root(spark, config)}/{name or config.metric_table}"
