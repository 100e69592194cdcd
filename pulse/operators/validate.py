"""The event contract checked on every record, with reasons.

A record's text is parsed once, to a VARIANT, which keeps the JSON types. One cast takes all
declared values out of it and one call describes its shape: names and JSON types. A record whose
shape and values are those of its event type is valid; only the others are taken apart, field
by field, for their reasons. All of it is column expressions, so validation is a map over
the scan without any shuffle. Reasons read ``rule:field``:

    empty_value, malformed_json, not_an_object
    missing:f, type:f, length:f, range:f, enum:f, timestamp:f
    forbidden:f (belongs to another event type), unknown:f (belongs to none)
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.contract import EVENT_CONTRACT, Contract, Field, merged
from pulse.functions.columns import event_timestamp, has_content, iso_utc, once
from pulse.operators.parse import broker_columns, with_broker_columns

# Fixed value: an ISO-8601 date-time; without an offset it is taken as UTC.
DATE_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})?$"

SMALLEST, LARGEST = -(2**31), 2**31 - 1  # of the integers that a flat column holds


def check_contract(records: DataFrame, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """Broker columns, raw text, ``violations``, ``is_valid`` and the flat event columns.

    The flat columns hold values of the declared type or null; they are complete
    for valid records. Of a repeated key the last value counts if the session has the
    job's settings (`configure`); without them such a text is ``malformed_json``.
    """
    looked_up, kept = _looked_up(records, [contract])
    # The verdict leaves through a generator: a filter on it stays above the rules
    # instead of taking a copy of all of them down to the scan.
    verdict = F.struct(F.col("reasons").alias("violations"), (F.size("reasons") == 0).alias("is_valid"))
    return (
        looked_up.withColumn("reasons", violations(contract, F.col("fits")[0]))
        .select("*", F.inline(F.array(verdict)))
        .select(*kept, "violations", "is_valid", *contract.flat_names)
    )


def check_versions(records: DataFrame, versions: Mapping[str, Contract]) -> DataFrame:
    """Broker columns, raw text and, for each named version of the contract, its array of violations.

    All versions judge the same parse, so a further version costs its rules only. A field
    that two versions declare with different types raises ValueError.
    """
    looked_up, kept = _looked_up(records, list(versions.values()))
    judged = [violations(contract, F.col("fits")[n]).alias(name) for n, (name, contract) in enumerate(versions.items())]
    return looked_up.select(*kept, *judged)


def verdict_changes(judged: DataFrame, old: str, new: str) -> DataFrame:
    """From `check_versions`: records by whether the two versions accept them, and the reasons that
    only one of them gives (``gone`` with the old one, ``added`` with the new one), sorted and comma-joined."""
    only = {"gone": F.array_except(old, new), "added": F.array_except(new, old)}
    return (
        judged.select(
            (F.size(old) == 0).alias("valid_before"),
            (F.size(new) == 0).alias("valid_after"),
            *[F.concat_ws(",", F.array_sort(reasons)).alias(name) for name, reasons in only.items()],
        )
        .groupBy("valid_before", "valid_after", "gone", "added")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _looked_up(records: DataFrame, versions: list[Contract]) -> tuple[DataFrame, list[str]]:
    """What the rules compare, and the names of the record's own columns.

    The flat columns; ``fits``, whether each version finds nothing to say; and for well-formed records
    that some version objects to, the JSON types of their fields by name. The values themselves are not
    kept: each variant of a map carries the names of the whole record along, and every step copies them.
    """
    together = merged(versions)
    text = with_broker_columns(records).select(*broker_columns(), F.col("value").cast("string").alias("raw_json"))
    # The parser stops after the first document. So the text is put into an array before a number that
    # stands for it: only if it is one complete element is that number the second one.
    mark = F.xxhash64("raw_json")
    framed = F.try_parse_json(F.concat(F.lit("["), F.col("raw_json"), F.lit(","), mark.cast("string"), F.lit("]")))
    parsed = once(text, "parsed", framed)

    def document(as_type: str) -> Column:
        # A text with more behind its first document is rejected, but may name its type: only such a text is parsed again.
        first = F.when(F.col("parsed").isNull(), F.try_variant_get(F.try_parse_json("raw_json"), "$", as_type))
        return F.coalesce(F.try_variant_get("parsed", "$[0]", as_type), first)

    decoded = parsed.withColumns(
        {
            "well_formed": F.coalesce(F.try_variant_get("parsed", "$[1]", "bigint") == mark, F.lit(False)),
            "shape": F.schema_of_variant(F.try_variant_get("parsed", "$[0]", "variant")),
        }
    ).select("*", F.inline(F.array(document(_wide_schema(together)))))
    fits = F.array(*[F.coalesce(F.col("well_formed") & _fits(version), F.lit(False)) for version in versions])
    judged = once(decoded, "fits", fits)

    def kinds(path: str) -> Column:
        found = F.try_variant_get("parsed", path, "map<string,variant>")
        return F.when(F.col("well_formed") & F.array_contains("fits", False),
                      F.transform_values(found, lambda _, value: F.schema_of_variant(value)))

    odd = F.struct(kinds("$[0]").alias("envelope_kinds"), kinds("$[0].payload").alias("payload_kinds"))
    opened = judged.select("*", F.inline(F.array(odd)))
    names = text.columns
    return opened.select(
        *names,
        "well_formed", "fits", "envelope_kinds", "payload_kinds",
        *[F.col(f.name) for f in together.envelope],
        *[_declared(f, F.col("payload")[f.name]).alias(f.name) for f in together.payload_fields],
    ), names


def split_by_contract(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). Each side is its own scan; to write both, use the archive sink's one pass."""
    return checked.filter("is_valid"), checked.filter("NOT is_valid")


def violation_counts(checked: DataFrame) -> DataFrame:
    """How many records break each rule."""
    return (
        checked.select(F.explode("violations").alias("violation"))
        .groupBy("violation")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def violations(contract: Contract, fits: Column) -> Column:
    """Array of reasons, over the columns that `_looked_up` gives; none where the record ``fits``."""
    keys = F.map_keys("envelope_kinds")
    reasons = F.concat(
        F.array(*[field_violation(f, "envelope_kinds") for f in contract.envelope]),
        _extra_keys(keys, [*_names(contract.envelope), "payload"]),
        payload_violations(contract),
    )
    # Reasons are unique within a record, so removing the nulls as a set loses nothing.
    # Unlike the higher-order `array_compact`, it leaves the rules in generated code.
    reasons = F.array_except(reasons, F.array(F.lit(None).cast("string")))
    return (
        F.when(fits, _none())
        .when(~F.coalesce(has_content(F.col("raw_json")), F.lit(False)), _one("empty_value"))
        .when(~F.col("well_formed"), _one("malformed_json"))
        .when(F.col("envelope_kinds").isNotNull(), reasons)
        .otherwise(_one("not_an_object"))
    )


def payload_violations(contract: Contract) -> Column:
    """Reasons within the payload, by the rules of the record's own event type."""
    everywhere = _names(contract.payload_fields)
    keys = F.map_keys("payload_kinds")
    reasons = F.when(F.try_element_at("envelope_kinds", F.lit("payload")).isNull(), _one("missing:payload"))
    reasons = reasons.when(F.col("payload_kinds").isNull(), _one("type:payload"))
    for event_type, fields in contract.payloads.items():
        own = _names(fields)
        of_type = F.concat(
            F.array(*[field_violation(f, "payload_kinds") for f in fields]),
            _extra_keys(keys, own, [name for name in everywhere if name not in own]),
        )
        reasons = reasons.when(F.col("event_type") == event_type, of_type)
    return reasons.otherwise(_none())


def field_violation(field: Field, place: str) -> Column:
    """The first rule the field breaks, or null; ``place`` is the map of JSON types that it stands in."""
    kind, value = F.try_element_at(place, F.lit(field.name)), F.col(field.name)
    broken = F.when(kind.isNull(), F.lit(f"missing:{field.name}") if field.required else F.lit(None))
    broken = broken.when(~_kind_matches(field.kind, kind), F.lit(f"type:{field.name}"))
    if field.kind == "integer":
        broken = broken.when((kind != "BIGINT") & value.isNull(), F.lit(f"type:{field.name}"))  # it has a fraction
    if field.kind == "timestamp":
        well_formed = value.rlike(DATE_TIME) & event_timestamp(value).isNotNull()
        return broken.when(~well_formed, F.lit(f"timestamp:{field.name}"))
    if field.choices:
        return broken.when(~value.isin(*field.choices), F.lit(f"enum:{field.name}"))
    measured, rule = (F.length(value), "length") if field.kind == "string" else (value, "range")
    # A number too large for the declared type has the right JSON type and no typed value.
    outside = value.isNull()
    if field.kind == "number":
        outside = outside | (F.abs(value) == float("inf"))  # beyond what a double holds
    if field.low is not None:
        outside = outside | (measured < field.low)
    if field.high is not None:
        outside = outside | (measured > field.high)
    return broken.when(outside, F.lit(f"{rule}:{field.name}"))


def _names(fields: Iterable[Field]) -> list[str]:
    return [f.name for f in fields]


def _wide_schema(contract: Contract) -> str:
    """The record's schema with integers as doubles, which tell a fraction and hold what an integer cannot."""
    def listed(fields: Iterable[Field]) -> str:
        types = {f.name: "double" if f.kind == "integer" else f.spark_type.simpleString() for f in fields}
        return ",".join(f"`{name}`:{kind}" for name, kind in types.items())

    return f"struct<{listed(contract.envelope)},`payload`:struct<{listed(contract.payload_fields)}>>"


def _declared(field: Field, wide: Column) -> Column:
    """The value as declared; an integer may be written with a fraction of zero."""
    return F.when(wide == F.floor(wide), wide.try_cast(field.spark_type)) if field.kind == "integer" else wide


#: JSON types of each declared kind, as the description of a variant names them.
NUMBER_SHAPE = r"(?:BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))"
SHAPES = {"integer": NUMBER_SHAPE, "number": NUMBER_SHAPE}


def _shape_pattern(fields: Iterable[Field], inner: str = "") -> str:
    """Pattern of an object with these fields, which the description lists in order of their names."""
    shapes = {f.name: (SHAPES.get(f.kind, "STRING"), f.required) for f in fields}
    if inner:
        shapes["payload"] = (inner, True)
    each = [f"(?:{re.escape(name)}: {shape}(?:, |(?=>))){'' if required else '?'}"
            for name, (shape, required) in sorted(shapes.items())]
    return f"OBJECT<{''.join(each)}>"


def _fits(contract: Contract) -> Column:
    """Whether nothing is wrong with the record. Null or false leaves it to the rules, field by field."""
    names = [*_names(contract.envelope), *_names(contract.payload_fields)]
    if not all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) for name in names):
        return F.lit(False)  # such names could be mistaken for a part of the description
    of_type = F.lit(False)
    for event_type, fields in reversed(contract.payloads.items()):
        shape = F.col("shape").rlike(f"^{_shape_pattern(contract.envelope, _shape_pattern(fields))}$")
        values = [_allowed(f, F.col("payload")[f.name]) for f in fields]
        of_type = F.when(F.col("event_type") == event_type, reduce(and_, values, shape)).otherwise(of_type)
    return reduce(and_, [_allowed(f, F.col(f.name)) for f in contract.envelope], of_type)


def _allowed(field: Field, value: Column) -> Column:
    """Whether a value of the right JSON type keeps the field's rules; ``value`` is null only where it is absent."""
    if field.kind == "timestamp":
        kept = value.rlike(DATE_TIME) & event_timestamp(value).isNotNull()
    elif field.choices:
        kept = value.isin(*field.choices)
    else:
        measured = F.length(value) if field.kind == "string" else value
        low, high = field.low, field.high
        if field.kind == "integer":
            low, high = max(low if low is not None else SMALLEST, SMALLEST), min(high if high is not None else LARGEST, LARGEST)
        kept = F.abs(value) < float("inf") if field.kind != "string" else value.isNotNull()
        kept = kept & (value == F.floor(value)) if field.kind == "integer" else kept
        kept = kept & (measured >= low) if low is not None else kept
        kept = kept & (measured <= high) if high is not None else kept
    return F.coalesce(kept, F.lit(False)) if field.required else (value.isNull() | kept)


def _kind_matches(declared: str, kind: Column) -> Column:
    """``kind`` is the JSON type; whether a number without fraction is meant is left to its value."""
    if declared == "integer":
        return (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
    if declared == "number":
        return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    return kind == "STRING"


def _extra_keys(keys: Column, allowed: list[str], elsewhere: list[str] | None = None) -> Column:
    """Reasons for keys the object should not have."""
    extra = F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))

    def reason(key: Column) -> Column:
        rule = F.when(key.isin(*elsewhere), "forbidden:").otherwise("unknown:") if elsewhere else F.lit("unknown:")
        return F.concat(rule, key)

    return F.when(F.size(extra) > 0, F.transform(extra, reason)).otherwise(_none())


def _none() -> Column:
    return F.array().cast("array<string>")


def _one(reason: str) -> Column:
    return F.array(F.lit(reason))


def apply_contract_defaults(events: DataFrame, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """Fill absent optional fields of flat events with the contract's defaults, per event type."""
    filled: dict[str, Column] = {}
    for event_type, fields in contract.payloads.items():
        for field in fields:
            if field.default is not None:
                so_far = filled.get(field.name, F.col(field.name))
                gap = F.col(field.name).isNull() & (F.col("event_type") == event_type)
                filled[field.name] = F.when(gap, F.lit(field.default).cast(field.spark_type)).otherwise(so_far)
    return events.withColumns(filled)


def canonical_times(events: DataFrame, contract: Contract = EVENT_CONTRACT) -> DataFrame:
    """Rewrite the time fields as ISO-8601 in UTC; text that is no time is left as it is."""
    return events.withColumns(
        {
            f.name: F.coalesce(iso_utc(event_timestamp(F.col(f.name))), F.col(f.name))
            for f in contract.envelope
            if f.kind == "timestamp"
        }
    )
