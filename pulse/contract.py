"""The event contract as data.

One table of fields drives the decode schema, the flat column list and every
validation rule. A new event type is one more entry (`Contract.extended`).
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


@dataclass(frozen=True)
class Field:
    """One contract field.

    ``low``/``high`` bound the length of a string and the value of a number.
    """

    name: str
    kind: str = "string"
    low: float | None = None
    high: float | None = None
    choices: tuple[str, ...] = ()
    required: bool = True
    default: str | None = None

    @property
    def spark_type(self) -> DataType:
        return {"integer": IntegerType(), "number": DoubleType()}.get(self.kind, StringType())


# Fixed values of the event contract: names, order, limits, choices and defaults.
PAYMENT_METHODS = ("credit_card", "pix", "debit_card", "wallet", "boleto")
PAYMENT_STATUSES = ("approved", "declined", "pending")
STOCK_REASONS = ("sale", "restock", "adjustment", "return")
EVENT_TYPES = ("page_view", "add_to_cart", "order_created", "payment_processed", "inventory_updated")

ENVELOPE = (
    Field("event_id", low=1, high=128),
    Field("event_type", choices=EVENT_TYPES),
    Field("event_time", kind="timestamp"),
    Field("producer_time", kind="timestamp"),
    Field("user_id", low=1, high=64),
    Field("session_id", low=1, high=128),
    Field("source", low=1, high=64),
)

PAYLOADS = {
    "page_view": (
        Field("page", low=1, high=128),
        Field("product_id", low=1, high=64),
        Field("category", low=1, high=64),
        Field("referrer", low=1, high=128, required=False, default="direct"),
    ),
    "add_to_cart": (
        Field("product_id", low=1, high=64),
        Field("quantity", kind="integer", low=1, high=100),
        Field("unit_price", kind="number", low=0),
        Field("currency", low=3, high=3, required=False, default="BRL"),
    ),
    "order_created": (
        Field("order_id", low=1, high=64),
        Field("items_count", kind="integer", low=1, high=1000),
        Field("total_amount", kind="number", low=0),
        Field("currency", low=3, high=3),
        Field("channel", low=1, high=32, required=False, default="web"),
    ),
    "payment_processed": (
        Field("payment_id", low=1, high=64),
        Field("order_id", low=1, high=64),
        Field("payment_method", choices=PAYMENT_METHODS),
        Field("payment_status", choices=PAYMENT_STATUSES),
        Field("amount", kind="number", low=0),
        Field("currency", low=3, high=3, required=False, default="BRL"),
    ),
    "inventory_updated": (
        Field("product_id", low=1, high=64),
        Field("warehouse_id", low=1, high=64),
        Field("delta_qty", kind="integer", low=-100000, high=100000),
        Field("stock_after", kind="integer", low=0, high=1000000),
        Field("reason", choices=STOCK_REASONS, required=False, default="adjustment"),
    ),
}

# Share of each event type that a healthy stream is expected to carry.
EXPECTED_MIX = {
    "page_view": 0.45,
    "add_to_cart": 0.20,
    "order_created": 0.12,
    "payment_processed": 0.13,
    "inventory_updated": 0.10,
}

# Topic per business domain, for deployments that split the single raw topic.
DOMAIN_TOPICS = {
    "page_view": "events.web",
    "add_to_cart": "events.commerce",
    "order_created": "events.commerce",
    "payment_processed": "events.payments",
    "inventory_updated": "events.inventory",
}

METRIC_COLUMNS = (
    "window_start",
    "window_end",
    "metric_name",
    "metric_value",
    "dimension_key",
    "dimension_value",
    "processed_at",
)


@dataclass(frozen=True)
class Contract:
    envelope: tuple[Field, ...]
    payloads: Mapping[str, tuple[Field, ...]]

    @property
    def event_types(self) -> list[str]:
        return list(self.payloads)

    @property
    def payload_fields(self) -> list[Field]:
        """Every payload field once, in order of first use over the event types."""
        seen: dict[str, Field] = {}
        for fields in self.payloads.values():
            for field in fields:
                known = seen.setdefault(field.name, field)
                if known.spark_type != field.spark_type:
                    raise ValueError(f"payload field {field.name!r} is declared with two types")
        return list(seen.values())

    @property
    def flat_names(self) -> list[str]:
        return [f.name for f in self.envelope] + [f.name for f in self.payload_fields]

    def payload_schema(self, names: Collection[str] | None = None) -> StructType:
        fields = [f for f in self.payload_fields if names is None or f.name in names]
        return StructType([StructField(f.name, f.spark_type) for f in fields])

    def envelope_schema(self, names: Collection[str] | None = None) -> StructType:
        """The record's schema, or the part of it that holds the named flat columns."""
        unknown = set(names or ()) - set(self.flat_names)
        if unknown:
            raise ValueError(f"not in the contract: {sorted(unknown)}")
        heads = [StructField(f.name, f.spark_type) for f in self.envelope if names is None or f.name in names]
        payload = self.payload_schema(names)
        return StructType([*heads, StructField("payload", payload)] if payload.fields else heads)

    def extended(self, event_type: str, fields: tuple[Field, ...]) -> Contract:
        """The same contract with one more (or one redefined) event type."""
        payloads = {**self.payloads, event_type: tuple(fields)}
        envelope = tuple(
            replace(f, choices=tuple(payloads)) if f.name == "event_type" else f for f in self.envelope
        )
        extended = Contract(envelope, payloads)
        clash = {f.name for f in envelope} & {f.name for f in extended.payload_fields}
        if clash:
            raise ValueError(f"payload fields {sorted(clash)} would hide envelope fields")
        return extended


EVENT_CONTRACT = Contract(ENVELOPE, PAYLOADS)


def merged(versions: Iterable[Contract]) -> Contract:
    """A contract that has every field of all versions, for looking them up; its rules are the first version's that has them."""
    envelope: dict[str, Field] = {}
    payloads: dict[str, dict[str, Field]] = {}
    for version in versions:
        for field in version.envelope:
            known = envelope.setdefault(field.name, field)
            if known.spark_type != field.spark_type:
                raise ValueError(f"envelope field {field.name!r} is declared with two types")
        for event_type, fields in version.payloads.items():
            of_type = payloads.setdefault(event_type, {})
            for field in fields:
                known = of_type.setdefault(field.name, field)
                if known.spark_type != field.spark_type:
                    raise ValueError(f"payload field {field.name!r} is declared with two types")
    together = Contract(tuple(envelope.values()), {t: tuple(f.values()) for t, f in payloads.items()})
    clash = set(envelope) & {f.name for f in together.payload_fields}
    if clash:
        raise ValueError(f"fields {sorted(clash)} stand in the envelope of one version and in the payload of another")
    return together


# A record as the broker delivers it.
RECORD_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

METRIC_SCHEMA = StructType(
    [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("metric_name", StringType()),
        StructField("metric_value", DoubleType()),
        StructField("dimension_key", StringType()),
        StructField("dimension_value", StringType()),
        StructField("processed_at", TimestampType()),
    ]
)
