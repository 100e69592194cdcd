from __future__ import annotations

import corpus_pipeline as P
from pulse.llm.decontaminate import find_contamination
from pulse.llm.neardup import near_duplicates
from pulse.llm.shared import written

SMALL = "/root/testdata/sf0.001"


def test_stages_apply_in_order(spark):
    docs = given = spark.read.parquet(f"{SMALL}/documents.parquet")
    after = {}
    for name, stage in P.STAGES[:-1]:
        docs = after[name] = written(stage(spark, docs, SMALL), name)
        assert docs.columns == given.columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    counts = [given.count(), *(d.count() for d in after.values())]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    lines = [x for r in after["line_dedup"].collect() for x in (r["text"] or "").split("\n") if len(x.split()) > 4]
    assert len(lines) == len(set(lines))
    assert all(r["n_chars"] == len(r["text"]) for r in after["line_dedup"].collect() if r["text"])
    classes = near_duplicates(after["line_dedup"]).select("class_id").distinct().count()
    assert after["near_dedup"].count() == classes == near_duplicates(after["near_dedup"]).select("class_id").distinct().count()
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert find_contamination(after["near_dedup"], benchmark).filter("contaminated").count() == (
        after["near_dedup"].count() - after["decontamination"].count())
    assert find_contamination(after["decontamination"], benchmark).filter("contaminated").count() == 0
    packed = P.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in after["decontamination"].collect()}


def test_stages_take_extra_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumnsRenamed({}).selectExpr(
        "*", "1 AS key", "'x' AS node", "'y' AS lines", "2 AS piece", "'z' AS `dotted.name`")
    for table in (docs.limit(0), docs.limit(30)):
        for name, stage in P.STAGES[:-1]:
            table = written(stage(spark, table, SMALL), name)
            assert table.columns == docs.columns
        assert P.STAGES[-1][1](spark, table, SMALL).columns[:3] == ["doc_id", "piece", "start"]
