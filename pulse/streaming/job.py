"""The streaming metrics job: broker topic to metric table."""

from __future__ import annotations

import argparse
import dataclasses
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulse.config import JobConfig
from pulse.operators.metrics import METRICS, Metric
from pulse.plans.pipeline import metrics_from_records
from pulse.sinks.metric_table import BatchWriter, metric_batch_writer
from pulse.sources.kafka import read_kafka_stream
from pulse.streaming.paths import checkpoint_location, shared_root

log = logging.getLogger(__name__)


def configure(spark: SparkSession, config: JobConfig) -> SparkSession:
    """Apply the job's settings to a session."""
    for key, value in config.session_conf().items():
        spark.conf.set(key, value)
    return spark


def start_metrics(
    records: DataFrame,
    config: JobConfig,
    write_batch: BatchWriter | None = None,
    metrics: Sequence[Metric] = METRICS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the named query: records in, closed windows out, one stateful operator."""
    spark = records.sparkSession
    if write_batch is None:
        root = config.table_root or shared_root(spark, config)
        write_batch = metric_batch_writer(f"{root.rstrip('/')}/tables/{config.metric_table}")
    trigger = {"availableNow": True} if available_now else {"processingTime": config.trigger_interval}
    return (
        metrics_from_records(records, config, metrics)
        .writeStream.outputMode("append")
        .queryName(config.query_name)
        .trigger(**trigger)
        .option("checkpointLocation", checkpoint_location(spark, config))
        .foreachBatch(write_batch)
        .start()
    )


def run(config: JobConfig, spark: SparkSession | None = None) -> int:
    """Run until the query ends. 0 on a regular end or an interrupt, 1 on failure."""
    query, own = None, spark is None
    try:
        spark = spark or SparkSession.builder.appName(config.app_name).getOrCreate()
        query = start_metrics(read_kafka_stream(configure(spark, config), config), config)
        log.info("query %s started, run %s", query.name, query.id)
        query.awaitTermination()
        return 0
    except KeyboardInterrupt:
        log.info("interrupted")
        return 0
    except Exception:
        log.exception("the metrics job failed")
        return 1
    finally:
        if query is not None and query.isActive:
            query.stop()
        if own and spark is not None:
            spark.stop()


def main(argv: Sequence[str] | None = None) -> int:
    """Entry for spark-submit: every text or number setting of `JobConfig` is an option."""
    parser = argparse.ArgumentParser(description=__doc__)
    for field in dataclasses.fields(JobConfig):
        if field.name == "extra_conf":
            continue
        kind = int if "int" in field.type else _boolean if "bool" in field.type else str
        parser.add_argument(f"--{field.name.replace('_', '-')}", type=kind, default=field.default)
    return run(JobConfig(**vars(parser.parse_args(argv))))


def _boolean(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise argparse.ArgumentTypeError("true or false")
    return text.lower() == "true"


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
