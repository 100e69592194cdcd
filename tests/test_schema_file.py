from __future__ import annotations

import copy
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from builders import event, records
from conftest import SMALL_DIR
from pulse.contract import EVENT_CONTRACT, Contract, Field, merged
from pulse.operators.validate import check_contract, check_versions, verdict_changes
from pulse.schema_file import breaking_changes, contract_of_schema, read_contract, schema_of_contract
from test_validate import CASES
from testkit.adapter import read_events
from testkit.faults import faulty_records

DOCUMENT = schema_of_contract(EVENT_CONTRACT)


def changed(path: list, value) -> dict:
    """The document with one place set, or taken out where the value is None."""
    document = copy.deepcopy(DOCUMENT)
    place = document
    for part in path[:-1]:
        place = place[part]
    if value is None:
        del place[path[-1]]
    else:
        place[path[-1]] = value
    return document


def with_field(contract: Contract, event_type: str, field: Field) -> Contract:
    others = [f for f in contract.payloads[event_type] if f.name != field.name]
    return Contract(contract.envelope, {**contract.payloads, event_type: (*others, field)})


def with_head(contract: Contract, name: str, **changes) -> Contract:
    return Contract(tuple(replace(f, **changes) if f.name == name else f for f in contract.envelope), contract.payloads)


def test_a_contract_survives_its_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps(DOCUMENT, indent=2))
    assert read_contract(spark, str(path)) == EVENT_CONTRACT


def test_notes_and_inline_objects_are_read():
    document = changed(["properties", "user_id", "description"], "who")
    document["allOf"][0]["then"]["properties"]["payload"] = document["$defs"]["page_view"]
    assert contract_of_schema(document) == EVENT_CONTRACT


@pytest.mark.parametrize(
    "path, value, message",
    [
        (["properties", "user_id", "pattern"], "u.*", "envelope|user_id.*pattern"),
        (["properties", "user_id", "type"], "array", "user_id has the type"),
        (["properties", "event_time", "format"], "email", "format 'email'"),
        (["$defs", "page_view", "additionalProperties"], True, "page_view is not a closed object"),
        (["$defs", "page_view", "required"], ["nothing"], "undeclared"),
        (["$defs", "page_view"], None, "no such definition"),
        (["allOf", 0, "then"], {"required": ["x"]}, "not a payload rule"),
        (["allOf", 0, "else"], {}, "says more"),
        (["allOf"], DOCUMENT["allOf"][1:], "without a payload rule"),
        (["allOf"], [*DOCUMENT["allOf"], DOCUMENT["allOf"][0]], "two rules"),
        (["properties", "payload", "oneOf"], [{"$ref": "#/$defs/page_view"}], "oneOf differs"),
        (["minProperties"], 3, "minProperties"),
        (["properties", "payload"], None, "no required payload"),
    ],
)
def test_what_the_contract_cannot_hold_is_an_error(path, value, message):
    with pytest.raises(ValueError, match=message):
        contract_of_schema(changed(path, value))


def test_same_verdicts_as_the_table_of_fields(spark):
    compiled = contract_of_schema(json.loads(json.dumps(DOCUMENT)))
    raw = records(spark, *[body for body, _ in CASES])
    found = check_contract(raw, compiled).orderBy("kafka_offset").collect()
    assert [sorted(r.violations) for r in found] == [sorted(expected) for _, expected in CASES]


def test_the_text_is_parsed_in_one_place(spark):
    plan = check_contract(faulty_records(read_events(spark, SMALL_DIR)))._jdf.queryExecution().optimizedPlan().toString()
    framed = [line for line in plan.splitlines() if "parseJson(concat([" in line]
    assert len(framed) == 1 and framed[0].count("parseJson(concat([") == 1
    assert "from_json" not in plan and "json_object_keys" not in plan


def test_names_that_need_quotes_go_by_the_rules(spark):
    odd = with_field(EVENT_CONTRACT, "page_view", Field("a: STRING, b", low=1, required=True))
    bodies = [event(payload={"a: STRING, b": "x"}), event(payload={"a": "x", "b": "x"})]
    rows = check_contract(records(spark, *bodies), odd).orderBy("kafka_offset").collect()
    assert [sorted(r.violations) for r in rows] == [[], ["missing:a: STRING, b", "unknown:a", "unknown:b"]]


@pytest.mark.parametrize(
    "field",
    [Field("n", "integer"), Field("n", "integer", low=-(2**40), high=2**40), Field("n", "number", high=5), Field("n", "integer", required=False)],
)
def test_open_limits(spark, field):
    """Numbers without limits, or with limits beyond the column's type, are judged as the column holds them."""
    contract = with_field(EVENT_CONTRACT, "page_view", field)
    values = [3, 2**31 - 1, 2**31, -(2**31), -(2**31) - 1, 3.0, 2.5, -7]
    rows = check_contract(records(spark, *[event(payload={"n": v}) for v in values]), contract).orderBy("kafka_offset").collect()
    if field.kind == "number":
        expected = [[], ["range:n"], ["range:n"], [], [], [], [], []]
    else:
        expected = [[], [], ["range:n"], [], ["range:n"], [], ["type:n"], []]
    assert [r.violations for r in rows] == expected
    assert all((r.n is not None) == r.is_valid for r in rows if field.kind == "integer")


def test_a_version_that_only_adds():
    more = EVENT_CONTRACT.extended("refund_issued", (Field("refund_id", low=1, high=8),))
    more = with_field(more, "page_view", Field("campaign", high=64, required=False))
    more = with_head(more, "source", low=0, high=128)
    assert breaking_changes(EVENT_CONTRACT, more) == []
    assert breaking_changes(EVENT_CONTRACT, EVENT_CONTRACT) == []


def test_a_version_that_takes_away():
    less = with_head(EVENT_CONTRACT, "source", low=2, high=32)
    less = with_field(less, "page_view", Field("campaign"))
    less = with_field(less, "add_to_cart", Field("quantity", low=1, high=3))
    less = with_field(less, "inventory_updated", Field("reason", choices=("sale",), required=True))
    payloads = {t: tuple(f for f in fields if f.name != "channel") for t, fields in less.payloads.items() if t != "payment_processed"}
    assert sorted(breaking_changes(EVENT_CONTRACT, Contract(less.envelope, payloads))) == sorted([
        "lower limit raised: envelope.source", "upper limit lowered: envelope.source", "required: page_view.campaign",
        "type integer to string: add_to_cart.quantity", "upper limit lowered: add_to_cart.quantity",
        "removed: order_created.channel", "event type removed: payment_processed",
        "required: inventory_updated.reason", "choices taken away: inventory_updated.reason",
        "default changed: inventory_updated.reason"])


def test_versions_side_by_side(spark):
    wider = with_head(with_field(EVENT_CONTRACT, "page_view", Field("note", required=False)), "user_id", required=False)
    bodies = [event(), event(without=["user_id"]), event(payload={"note": "x"}), event(without=["user_id", "source"]), "{", None]
    judged = check_versions(records(spark, *bodies), {"v1": EVENT_CONTRACT, "v2": wider})
    rows = judged.orderBy("kafka_offset").collect()
    assert [r.v1 for r in rows] == [[], ["missing:user_id"], ["unknown:note"], ["missing:user_id", "missing:source"],
                                    ["malformed_json"], ["empty_value"]]
    assert [r.v2 for r in rows] == [[], [], [], ["missing:source"], ["malformed_json"], ["empty_value"]]
    found = {(r.valid_before, r.valid_after, r.gone, r.added): r.n_records for r in verdict_changes(judged, "v1", "v2").collect()}
    assert found == {(True, True, "", ""): 1, (False, True, "missing:user_id", ""): 1, (False, True, "unknown:note", ""): 1,
                     (False, False, "missing:user_id", ""): 1, (False, False, "", ""): 2}


def test_each_version_judges_as_it_would_alone(spark):
    raw = faulty_records(read_events(spark, SMALL_DIR))
    other = with_head(with_head(EVENT_CONTRACT, "user_id", required=False), "session_id", low=0)
    judged = check_versions(raw, {"v1": EVENT_CONTRACT, "v2": other})
    for name, contract in (("v1", EVENT_CONTRACT), ("v2", other)):
        alone = check_contract(raw, contract).select("kafka_offset", F.array_sort("violations"))
        assert judged.select("kafka_offset", F.array_sort(name)).exceptAll(alone).count() == 0


def test_versions_that_cannot_be_looked_up_together():
    texts = with_field(EVENT_CONTRACT, "add_to_cart", Field("quantity"))
    with pytest.raises(ValueError, match="two types"):
        merged([EVENT_CONTRACT, texts])
