"""The filter audit against a plain count over every order."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest

from pulse.llm.filteraudit import audit_filters, audit_interactions, removal_ranks, text_mask

DOCS = "doc_id bigint, text string, source string, part string, mask string, n string, good string"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def failures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {"A"} if len(words) < 50 else set()
    if 100 * len(set(words)) < 65 * len(words):
        found.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        found.add("C")
    if re.search(r"[#$%&*|]", text):
        found.add("D")
    return found


def brute_audit(docs, labels):
    docs = [(i, t or "", s or "") for i, t, s in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    flagged = [(i, s, failures(t) | ({"E"} if i is not None and i > least[t] else set())) for i, t, s in docs]
    orders, rows = ["".join(o) for o in permutations("ABCDE")], {}
    for part in {s for _, s, _ in flagged}:
        own, shapley = [(i, f) for i, s, f in flagged if s == part], dict.fromkeys("ABCDE", 0)
        for order in orders:
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                earlier = set(order[: step - 1])
                left = [(i, f) for i, f in left if letter not in f]
                shapley[letter] += len(gone)
                rows[part, order, step] = [
                    len(left), len(gone), sum(letter in f and bool(f & earlier) for _, f in own),
                    sum(f == {letter} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for order in orders:
            for step, letter in enumerate(order, 1):
                rows[part, order, step].append(shapley[letter])
    return rows


def check(spark, docs, labels):
    table = spark.createDataFrame([(i, t, s, "x", "y", "z", "w") for i, t, s in docs], DOCS)
    marks = spark.createDataFrame([(*row, "p") for row in labels], LABELS)
    found = audit_filters(table, marks).collect()
    assert {tuple(r)[:3]: list(r)[3:] for r in found} == brute_audit(docs, labels)
    assert len(found) == len({s or "" for _, _, s in docs}) * 600


PROSE = " ".join(f"word{i}" for i in range(60))


def test_nulls_repeats_ties_and_long_texts(spark):
    docs = [
        (3, PROSE, "a"), (1, PROSE, "b"), (2, PROSE, None), (None, PROSE, "a"), (None, PROSE, ""), (1, PROSE, "b"),
        (1, PROSE, "a"), (4, None, "a"), (5, "", "b"), (6, "SHOUT " * 70, "a"), (6, "other text with $", "a"),
        (7, "x" * 3_000_000, "b"), (8, "ü  " * 80, "a"), (9, "a\x0bb\x0cc\x1cd " * 60, None), (10, "50 % off", "b"),
    ]
    check(spark, docs, [(1, 1, 0), (1, 0, 1), (3, 1, 1), (4, None, 1), (None, 1, 1), (7, 1, None), (99, 1, 1)])


def test_a_hot_text_in_one_source(spark):
    docs = [(i, PROSE if i % 3 == 0 else f"text {i}", "hot" if i % 2 else f"s{i % 5}") for i in range(600)]
    check(spark, docs, [(i, i % 2, int(i % 3 == 0)) for i in range(0, 600, 7)])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert audit_filters(empty, spark.createDataFrame([], LABELS)).count() == 0
    check(spark, [(1, "a", "s")], [])


def test_a_corpus_of_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    found = {tuple(r)[:3]: list(r)[3:] for r in audit_filters(table, labels).collect()}
    docs = [tuple(r) for r in table.select("doc_id", "text", "source").collect()]
    assert found == brute_audit(docs, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_other_filters_and_marks(spark):
    counts = spark.createDataFrame([("p", 0, 4, 1), ("p", 3, 2, 2), ("p", 5, 3, 0), ("q", 0, 1, 1)], "part string, mask int, n long, rare long")
    rows = {(r["part"], r["filter_order"], r["step"]): r for r in audit_interactions(counts, "XYZ", ["rare"]).collect()}
    assert len(rows) == 2 * 6 * 3
    first = rows["p", "XYZ", 1]
    assert (first["kept"], first["removed"], first["redundant"], first["rare_lost"]) == (4, 5, 0, 2)
    assert rows["p", "YXZ", 2]["removed"] == 3 and rows["p", "YXZ", 2]["redundant"] == 2
    assert rows["p", "YXZ", 3]["redundant"] == 3 and rows["q", "ZYX", 3]["kept"] == 1


def test_removal_ranks_are_first_failing_steps():
    orders = np.array(list(permutations(range(4))))
    ranks = removal_ranks(np.arange(16), orders)
    for mask in range(16):
        for at, order in enumerate(orders):
            assert ranks[mask, at] == next((s for s, f in enumerate(order) if mask >> f & 1), 4)


@pytest.mark.parametrize("text", ["", " ", "A", "é" * 30 + "A", "word " * 49, "word " * 50, PROSE, PROSE + "|", "\x85\xa0 x", "#"])
def test_masks_of_single_texts(text):
    assert text_mask(text.encode()) == sum(1 << "ABCDE".index(x) for x in failures(text))


def test_column_types(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id int, text string, source string")
    types = dict(audit_filters(docs, spark.createDataFrame([], LABELS)).dtypes)
    assert types.pop("part") == types.pop("filter_order") == "string" and types.pop("step") == "int"
    assert set(types.values()) == {"bigint"}
