"""Publishing events to Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import JobConfig
from pulse.contract import EVENT_CONTRACT, Contract

# Producer settings of the event topic.
PRODUCER_SETTINGS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.linger.ms": "25",
    "kafka.batch.size": "32768",
    "kafka.compression.type": "lz4",
    "kafka.retries": "10",
    "kafka.retry.backoff.ms": "500",
}


def sink_options(config: JobConfig, with_topic: bool = True) -> dict[str, str]:
    """Writer options; without a topic the records' own ``topic`` column decides."""
    options = {"kafka.bootstrap.servers": config.bootstrap_servers, "kafka.client.id": config.app_name}
    if with_topic:
        options["topic"] = config.topic
    return {**options, **PRODUCER_SETTINGS}


def to_kafka_records(events: DataFrame, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """Flat events to (key, value): key is the user, value the JSON envelope.

    A payload carries the fields of its own event type that have a value. Events have to
    be parsed ones: normalisation replaces absent numbers by 0, which would be published as data.
    """
    if "payment_attempt_flag" in events.columns:
        raise ValueError("normalised events hold 0 where a number was absent; publish parsed events")
    owners = {
        f.name: [event_type for event_type, fields in contract.payloads.items() if f.name in {g.name for g in fields}]
        for f in contract.payload_fields
    }
    payload = [F.when(F.col("event_type").isin(*types), F.col(name)).alias(name) for name, types in owners.items()]
    value = F.to_json(F.struct(*[f.name for f in contract.envelope], F.struct(*payload).alias("payload")))
    topic = ["topic"] if "topic" in events.columns else []
    return events.select(F.col("user_id").alias("key"), value.alias("value"), *topic)


def publish_events(events: DataFrame, config: JobConfig, contract: Contract = EVENT_CONTRACT):
    """Write a batch of flat events, or return the stream writer for a streaming one."""
    records = to_kafka_records(events, contract)
    options = sink_options(config, "topic" not in records.columns)
    if records.isStreaming:
        return records.writeStream.format("kafka").options(**options)
    return records.write.format("kafka").options(**options).save()
