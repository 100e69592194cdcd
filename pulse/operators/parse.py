"""Raw broker records to flat event columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.contract import EVENT_CONTRACT, RECORD_SCHEMA, Contract
from pulse.functions.columns import has_content

BROKER_COLUMNS = ("key", "topic", "partition", "offset", "timestamp")


def with_broker_columns(records: DataFrame) -> DataFrame:
    """Give records from files the broker columns they lack, as nulls."""
    present = set(records.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RECORD_SCHEMA if f.name not in present}
    return records.withColumns(missing) if missing else records


def broker_columns() -> list:
    """The broker's own columns under their ``kafka_`` names."""
    return [
        (F.col(name).cast("string") if name == "key" else F.col(name)).alias(f"kafka_{name}")
        for name in BROKER_COLUMNS
    ]


def parse_events(
    records: DataFrame,
    contract: Contract = EVENT_CONTRACT,
    fields: Collection[str] | None = None,
) -> DataFrame:
    """Decode the JSON value and flatten envelope and payload: 31 columns.

    The struct is unfolded by a generator, so the text is decoded once however
    many filters follow. The optimizer cannot prune such a schema by itself; a
    caller that needs few columns names them in ``fields``.
    """
    schema = contract.envelope_schema(fields)
    payload = [f for f in schema if f.name == "payload"]
    decoded = (
        with_broker_columns(records)
        .filter(has_content(F.col("value")))
        .select(
            *broker_columns(),
            F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))),
        )
    )
    return decoded.select(
        *[f"kafka_{name}" for name in BROKER_COLUMNS],
        *[f.name for f in schema if f.name != "payload"],
        *[F.col("payload")[f.name].alias(f.name) for p in payload for f in p.dataType],
    )
