"""Kafka source: one topic of raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.config import JobConfig


def source_options(config: JobConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    # Bound the first batch of a replay, and read a topic of few partitions with more tasks.
    if config.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    if config.min_partitions is not None:
        options["minPartitions"] = str(config.min_partitions)
    return options


def read_kafka_stream(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Needs the public Kafka connector package on the class path."""
    return spark.readStream.format("kafka").options(**source_options(config)).load()
