"""The event contract as a JSON-schema file: read from one, written as one, and compared between versions.

The file describes one closed object: the envelope's fields, and under ``payload`` one closed object
for each event type, chosen by ``if``/``then`` on the constant of ``event_type``. A keyword that has no
place in the contract raises ValueError with its path, so no rule of a file is left out unseen.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from typing import Any

from pyspark.sql import SparkSession

from pulse.contract import Contract, Field

Schema = Mapping[str, Any]

NOTES = {"description", "title", "$comment", "examples", "deprecated"}
DIALECT = "https://json-schema.org/draft/2020-12/schema"


def read_contract(spark: SparkSession, path: str) -> Contract:
    """The contract of a schema file, which may lie wherever Spark reads text."""
    return contract_of_schema(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def contract_of_schema(document: Schema) -> Contract:
    """The contract that a schema document declares."""
    known = {"$schema", "$id", "$defs", "allOf", "type", "additionalProperties", "required", "properties"}
    _only(document, known, "the document")
    heads = dict(document["properties"])
    if "payload" not in heads or "payload" not in document.get("required", ()):
        raise ValueError("the document has no required payload")
    payload = heads.pop("payload")
    _only(payload, {"type", "oneOf"}, "payload")
    envelope = _fields({**document, "properties": heads}, "the document", ignored={"$schema", "$id", "$defs", "allOf"})
    payloads = {}
    for n, rule in enumerate(document.get("allOf", ())):
        event_type, shape = _payload_rule(rule, f"allOf/{n}")
        if event_type in payloads:
            raise ValueError(f"two rules for the event type {event_type!r}")
        payloads[event_type] = _fields(_resolved(shape, document), event_type)
    named = next((f.choices for f in envelope if f.name == "event_type"), ())
    if set(named) != set(payloads):
        raise ValueError(f"event types without a payload rule, or rules without a type: {sorted(set(named) ^ set(payloads))}")
    # A record of no listed type breaks the enum; the alternatives say no more than the rules by type.
    offered = [_resolved(s, document) for s in payload.get("oneOf", ())]
    if offered and sorted(map(_canonical, offered)) != sorted(
            _canonical(_resolved(_payload_rule(r, "")[1], document)) for r in document["allOf"]):
        raise ValueError("payload/oneOf differs from the rules by event type")
    contract = Contract(envelope, {t: payloads[t] for t in named})
    clash = {f.name for f in envelope} & {f.name for f in contract.payload_fields}
    if clash:
        raise ValueError(f"payload fields {sorted(clash)} would hide envelope fields")
    return contract


def schema_of_contract(contract: Contract) -> dict[str, Any]:
    """The schema document of a contract; `contract_of_schema` gives the same contract back."""
    head = _object(contract.envelope)
    head["properties"]["payload"] = {"oneOf": [{"$ref": f"#/$defs/{t}"} for t in contract.payloads]}
    head["required"].append("payload")
    rules = [
        {
            "if": {"properties": {"event_type": {"const": t}}, "required": ["event_type"]},
            "then": {"properties": {"payload": {"$ref": f"#/$defs/{t}"}}},
        }
        for t in contract.payloads
    ]
    return {"$schema": DIALECT, **head, "allOf": rules, "$defs": {t: _object(f) for t, f in contract.payloads.items()}}


def breaking_changes(old: Contract, new: Contract) -> list[str]:
    """What the new version takes away: reasons why a record that the old one accepts, or a reader of its columns, may fail.

    Empty for a version that only adds: event types, optional fields, choices and wider limits.
    """
    changes = list(_field_changes("envelope", old.envelope, new.envelope))
    for event_type, fields in old.payloads.items():
        if event_type in new.payloads:
            changes += _field_changes(event_type, fields, new.payloads[event_type])
        else:
            changes.append(f"event type removed: {event_type}")
    return changes


def _field_changes(place: str, old: tuple[Field, ...], new: tuple[Field, ...]) -> Iterator[str]:
    after = {f.name: f for f in new}
    before = {f.name: f for f in old}
    for field in new:
        if field.required and not (field.name in before and before[field.name].required):
            yield f"required: {place}.{field.name}"
    for name, was in before.items():
        now = after.get(name)
        if now is None:
            yield f"removed: {place}.{name}"
            continue
        if now.kind != was.kind:
            yield f"type {was.kind} to {now.kind}: {place}.{name}"
        if now.low is not None and (was.low is None or now.low > was.low):
            yield f"lower limit raised: {place}.{name}"
        if now.high is not None and (was.high is None or now.high < was.high):
            yield f"upper limit lowered: {place}.{name}"
        if now.choices and not (was.choices and set(was.choices) <= set(now.choices)):
            yield f"choices taken away: {place}.{name}"
        if was.default != now.default and was.default is not None:
            yield f"default changed: {place}.{name}"


def _fields(schema: Schema, place: str, ignored: frozenset[str] | set[str] = frozenset()) -> tuple[Field, ...]:
    _only(schema, {"type", "additionalProperties", "required", "properties", *ignored}, place)
    if schema.get("type") != "object" or schema.get("additionalProperties") is not False:
        raise ValueError(f"{place} is not a closed object")
    required = set(schema.get("required", ()))
    undeclared = required - set(schema["properties"]) - {"payload"}
    if undeclared:
        raise ValueError(f"{place} requires undeclared fields {sorted(undeclared)}")
    return tuple(_field(name, rules, name in required, f"{place}.{name}") for name, rules in schema["properties"].items())


def _field(name: str, rules: Schema, required: bool, place: str) -> Field:
    kind = rules.get("type")
    limits = {"string": ("minLength", "maxLength"), "integer": ("minimum", "maximum"), "number": ("minimum", "maximum")}
    if kind not in limits:
        raise ValueError(f"{place} has the type {kind!r}")
    low, high = limits[kind]
    # A text is a time, one of several values, or bounded; the contract holds one of these for a field.
    own = {low, high}
    if kind == "string" and "format" in rules:
        if rules["format"] != "date-time":
            raise ValueError(f"{place} has the format {rules['format']!r}")
        kind, own = "timestamp", {"format"}
    elif kind == "string" and "enum" in rules:
        own = {"enum"}
    _only(rules, {"type", "default", *own}, place)
    return Field(name, kind, rules.get(low), rules.get(high), tuple(rules.get("enum", ())), required, rules.get("default"))


def _object(fields: tuple[Field, ...]) -> dict[str, Any]:
    return {
        "type": "object",
        "additionalProperties": False,
        "required": [f.name for f in fields if f.required],
        "properties": {f.name: _rules(f) for f in fields},
    }


def _rules(field: Field) -> dict[str, Any]:
    low, high = ("minLength", "maxLength") if field.kind == "string" else ("minimum", "maximum")
    rules = {
        "type": "string" if field.kind == "timestamp" else field.kind,
        "format": "date-time" if field.kind == "timestamp" else None,
        "enum": list(field.choices) or None,
        low: field.low,
        high: field.high,
        "default": field.default,
    }
    return {keyword: value for keyword, value in rules.items() if value is not None}


def _payload_rule(rule: Schema, place: str) -> tuple[str, Schema]:
    """``(event type, payload schema)`` of one ``if``/``then``."""
    try:
        event_type = rule["if"]["properties"]["event_type"]["const"]
        shape = rule["then"]["properties"]["payload"]
    except (KeyError, TypeError) as other:
        raise ValueError(f"{place} is not a payload rule by event type") from other
    alike = {"if": {"properties": {"event_type": {"const": event_type}}, "required": ["event_type"]},
             "then": {"properties": {"payload": shape}}}
    if {k: v for k, v in rule.items() if k not in NOTES} != alike:
        raise ValueError(f"{place} says more than a payload rule by event type")
    return event_type, shape


def _resolved(schema: Schema, document: Schema) -> Schema:
    if "$ref" not in schema:
        return schema
    found: Any = document
    for part in schema["$ref"].removeprefix("#/").split("/"):
        if not isinstance(found, Mapping) or part not in found:
            raise ValueError(f"no such definition: {schema['$ref']}")
        found = found[part]
    return found


def _only(schema: Schema, known: set[str], place: str) -> None:
    unknown = set(schema) - known - NOTES
    if unknown:
        raise ValueError(f"{place}: the contract has no place for {sorted(unknown)}")


def _canonical(schema: Schema) -> str:
    return json.dumps(schema, sort_keys=True)
