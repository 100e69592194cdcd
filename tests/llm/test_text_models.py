"""Quality rules, near-duplicates, toxicity, shingles and line dedup against brute force and on edge rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulse.llm import linededup, neardup, quality, toxicity
from pulse.llm import queries as Q
from pulse.llm.linededup import dedup_lines, drop_repeated_lines
from pulse.llm.membership import contained, hash_keys, members
from pulse.llm.neardup import BANDS, ROWS, components, keep_one_of_each, near_duplicates, signatures, weighted_jaccard
from pulse.llm.shared import workspace
from pulse.llm.shingles import Sketch, chunks, distinct, shingles, text_buffer

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, node string, key int, removed_lines string, `a.b` string"
ROW = ("en", "n", 1, "r", "dot")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingle_list(text):
    ws = words(text)
    return [" ".join(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1 if ws else 0))]


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, *ROW) for i, t in zip(ids, texts)], DOCS)


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


# ---- shingles ----------------------------------------------------------------------------------


def test_shingles_against_brute_force():
    texts = ["", None, "One two", "a b c d e", "A,b.c;D e f! é É a b c d e", "x" * 3_000_000 + " y", "a\nb", "  lead", "\x7fa\x7fb"]
    data, offsets = text_buffer(pa.array(texts))
    found = defaultdict(list)
    for start, stop in chunks(offsets, 64):
        row, value = shingles(data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start])
        for r, v in zip(row.tolist(), value.tolist()):
            found[r + start].append(v)
    names = {}
    for i, text in enumerate(texts):
        expected = shingle_list(text)
        assert len(found[i]) == len(expected)
        for s, v in zip(expected, found[i]):
            assert names.setdefault(s, v) == v
    assert len(set(names.values())) == len(names)


def test_sketch_tells_frequent_from_rare():
    rng = np.random.default_rng(1)
    rare, common = rng.integers(0, 1 << 63, 400_000, np.uint64), rng.integers(0, 1 << 63, 50, np.uint64)
    sketch = Sketch()
    sketch.add(rare)
    sketch.add(np.repeat(common, 1000))
    assert np.abs(sketch.counts(common) - 1000).max() < 20
    assert np.median(sketch.counts(rare)) < 3


# ---- line dedup: the SQL check covers whole tables ------------------------------------------------


def brute_lines(rows, threshold=0.8):
    """(key, line) of removed lines."""
    places = sorted(((k is None, k or 0), n, frozenset(shingle_list(line))) for k, t in rows if t is not None
                    for n, line in enumerate(t.split("\n")) if words(line))
    gone, seen = set(), {}
    for key, line, tokens in places:
        if any(jaccard(tokens, s) >= threshold for s, place in seen.items() if place < (key, line)):
            gone.add((None if key[0] else key[1], line))
        seen.setdefault(tokens, (key, line))
    return gone


def variants(rng, base, n):
    out = []
    for _ in range(n):
        ws = base.split()
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            ws[rng.randrange(len(ws))] = "edit" + str(rng.randrange(10**6))
        out.append(" ".join(ws))
    return out


def line_rows():
    rng = random.Random(3)
    base, other = sentence(rng, 60), sentence(rng, 12)
    texts = ["\n".join([v, sentence(rng, 9), w, "Short."]) for v, w in zip(variants(rng, base, 60), variants(rng, other, 60))]
    texts += [None, "", "\n\n", "short\nSHORT!\n\nshort", "é è\nÉ è", base, base + " tail", "z " * 40_000, "z " * 39_000,
              sentence(rng, 30_000)]
    return list(zip(range(len(texts)), texts)) + [(None, "Short."), (500, base + "\nnew words here"), (500, base + "\nnew words here")]


def test_line_dedup_edge_rows(spark):
    rows = line_rows()
    docs = table(spark, [t for _, t in rows], [k for k, _ in rows])
    gone = brute_lines(rows)
    assert len(gone) > 100
    found = dedup_lines(docs).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        lines = sorted(n for k, n in gone if k == r["doc_id"])
        assert (r["removed_lines"] or []) == lines, r["doc_id"]
        text = texts[r["doc_id"]]
        assert r["text"] == (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lines))
    kept = drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    lost = {r["doc_id"] for r in found if r["removed_lines"] and not words(r["text"])}
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(k) for k, _ in rows if k not in lost)
    assert dedup_lines(docs.limit(0)).count() == 0 and drop_repeated_lines(docs.limit(0)).count() == 0


def test_lines_that_share_half_their_words_are_not_dealt_out(spark):
    """Of many pairs of lines only those that the bounds leave open arrive as postings; whoever is similar does."""
    rng = random.Random(17)
    texts, similar = [], set()
    for i in range(0, 400, 2):
        base = sentence(rng, 30)
        texts += [base, " ".join(base.split()[:18]) + " " + sentence(rng, 12) if i % 20 else base + " more"]
        similar |= set() if i % 20 else {i, i + 1}
    plain = table(spark, texts).select(F.col("doc_id").alias("key"), "text", F.xxhash64("text").alias("body"))
    with workspace(spark):
        sketch = linededup.occurrences(plain)[1]
        postings = {r["key"] for r in linededup.shared_tokens(plain, sketch, 0.8).collect()}
    assert postings == similar
    found = {r["doc_id"]: r["removed_lines"] for r in dedup_lines(table(spark, texts)).collect()}
    assert found == {i: [0] if i in similar and i % 2 else None for i in range(400)}


def test_lines_of_tokens_dealt_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(linededup, "HOT_TOKEN", 3)
    rows = line_rows()[:60] + line_rows()[-3:]
    found = dedup_lines(table(spark, [t for _, t in rows], [k for k, _ in rows])).collect()
    gone = brute_lines(rows)
    assert len(gone) > 100
    assert all((r["removed_lines"] or []) == sorted(n for k, n in gone if k == r["doc_id"]) for r in found)


def test_entries_that_may_match_by_bounds():
    """In small groups exactly those that some other entry may match; in larger ones all."""
    rng = np.random.default_rng(9)
    entries = np.zeros(500, linededup._ENTRY)
    entries["token"] = np.concatenate([rng.integers(0, 60, 400), np.full(100, 99)])
    entries["name"], entries["key"] = np.arange(500), rng.permutation(500)
    entries["n"], entries["place"] = rng.integers(5, 12, 500), rng.integers(0, 2, 500)
    entries["mark"] = rng.integers(0, 1 << 4, 500)
    kept, rank, counts = linededup.with_company(entries)
    open_ = linededup.may_match(kept, rank, counts, 0.8)
    assert open_[kept["token"] == 99].all() and 0 < open_.sum() < len(kept)
    for token in range(60):
        own = kept[kept["token"] == token]
        assert rank[kept["token"] == token].tolist() == list(range(len(own))) and (np.diff(own["key"]) > 0).all()

        def pair(a, b):
            needed = math.ceil((a["n"] + b["n"]) * 0.8 / 1.8 - 1e-9)
            return (min(a["n"], b["n"]) >= 0.8 * max(a["n"], b["n"]) - 1e-9
                    and min(a["n"] - a["place"], b["n"] - b["place"]) >= needed
                    and int(a["mark"] ^ b["mark"]).bit_count() <= a["n"] + b["n"] - 2 * needed)

        expected = [any(pair(a, b) for j, b in enumerate(own) if j != i) for i, a in enumerate(own)]
        assert open_[kept["token"] == token].tolist() == expected


def test_postings_travel_in_few_bytes_over_many_buckets(spark, monkeypatch):
    """Neither the text's hash of a key with one row nor the name of a set with one line travels."""
    monkeypatch.setattr(linededup, "BUCKET_SHINGLES", 8_000)
    rng = random.Random(23)
    docs = table(spark, [sentence(rng, 34) for _ in range(3000)]).coalesce(1)
    number, body = linededup.row_place(docs, "doc_id", "text")
    plain = docs.select(number.alias("key"), "text", body.alias("body"))
    with workspace(spark):
        sketch = linededup.occurrences(plain)[1]
        rows = linededup.packed_entries(plain, sketch, 0.8, members(plain.filter("key < 0").select("key"))).collect()
    assert len(rows) > 5
    count = sum(r["count"] for r in rows)
    assert count > 10_000 and sum(len(r["entries"]) for r in rows) < 20 * count  # 25 and more before
    for r in rows:
        entries = linededup.unpack_entries(r["entries"], r["count"])
        assert (np.diff(entries["key"]) >= 0).all() and not entries["name"].any() and not entries["body"].any()


def test_packed_entries_arrive_as_they_were():
    rng = np.random.default_rng(4)
    entries = np.zeros(700, linededup._ENTRY)
    for field in ("key", "body"):
        entries[field] = rng.integers(-(1 << 63), (1 << 63) - 1, 700)
    for field in ("line", "n", "place"):
        entries[field] = rng.integers(0, 1 << 31, 700)
    entries["mark"] = rng.integers(0, 1 << 64, 700, np.uint64)
    for field in ("token", "name"):
        entries[field] = rng.integers(0, 1 << 64, 700, np.uint64) & linededup.SENT
    assert (linededup.unpack_entries(linededup.pack_entries(entries), 700) == entries).all()


def test_a_filter_counts_its_keys_once(spark):
    jobs = []
    for n in (10, 200_000):
        spark.sparkContext.setJobGroup(f"members-{n}", "")
        filled = members(spark.range(n))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"members-{n}")))
        assert contained(filled, hash_keys(np.arange(n))).all()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_short_lines_with_like_hashes_stay(spark):
    """The shingles of each pair agree in their first 44 bits."""
    texts = ["w4334664\nw7541184", "w6930488\nw8376416\nw4827717", "w7584642", "w4334664 "]
    found = {r["doc_id"]: r["removed_lines"] for r in dedup_lines(table(spark, texts)).collect()}
    assert found == {0: None, 1: None, 2: None, 3: [0]}


def test_rows_of_one_key_with_different_texts_are_different_documents(spark):
    texts = ["one two\nown of the first\nthree", "one two\nown of the second\nfour", "five\nsix\none two", "one two\nseven"]
    for key in (None, 4):
        found = dedup_lines(table(spark, [*texts, texts[0]], [key] * 4 + [key])).collect()
        left = Counter(r["text"] for r in found)
        lines = Counter(line for text in set(left) for line in text.split("\n"))
        assert lines == Counter(["one two", "own of the first", "three", "own of the second", "four", "five", "six", "seven"])
        assert sorted(left.values()) == [1, 1, 1, 2]  # copies of a row stay alike


def test_more_lines_than_are_packed_at_once(spark):
    n = 1 << 20
    texts = ["gamma delta\n" + "\n" * (n - 1) + "alpha beta\nalpha beta\ngamma delta\nlast", "gamma delta", "LAST"]
    found = {r["doc_id"]: r["removed_lines"] for r in dedup_lines(table(spark, texts)).collect()}
    assert found == {0: [n + 1, n + 2], 1: [0], 2: [0]}


# ---- near-duplicates ---------------------------------------------------------------------------


def brute_classes(rows, threshold):
    sets = {k: set(shingle_list(t)) for k, t in rows}
    texts = {k: t or "" for k, t in rows}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and (texts[a] == texts[b] or jaccard(sets[a], sets[b]) >= threshold):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


def test_near_duplicate_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = {r["doc_id"]: r["class_id"] for r in Q.op6_near_duplicates(spark, SMALL).collect()}
    assert found == brute_classes(rows, 0.8)


def test_near_duplicate_groups_and_edge_rows(spark):
    rng = random.Random(5)
    bases = [sentence(rng, 400) for _ in range(4)]
    texts = [v for base in bases for v in variants(rng, base, 40)]
    texts += [None, "", "", "...", "...", "two words", "Two, words!", "one\ntwo three four five", "w " * 50_000, sentence(rng, 40_000)]
    rows = list(enumerate(texts))
    docs = table(spark, texts)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    assert found == brute_classes(rows, 0.8)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(found.values()))
    assert near_duplicates(docs.limit(0)).count() == 0 and keep_one_of_each(docs.limit(0)).count() == 0
    repeated = table(spark, ["same text of five words", "same text of five words", "other", "nothing", "nothing"], [3, 3, 1, None, None])
    assert sorted(repr(r["doc_id"]) for r in keep_one_of_each(repeated).collect()) == ["1", "3", "None"]


def test_near_duplicates_link_linked_nodes_of_different_classes(spark, monkeypatch):
    """B links to D and A to the hub H; only A and B, which meet in a band with H, join the two classes."""
    rng = random.Random(11)
    core, tail = sentence(rng, 400).split(), sentence(rng, 400).split()
    h, a, b, d = ("\n".join(part) for part in (core, core[38:], core[68:] + tail[:24], core[68:] + tail[:60]))
    texts = {"h": h, "a": a, "b": b, "d": d, "other": sentence(rng, 300)}
    sets = {k: set(shingle_list(t)) for k, t in texts.items()}
    assert jaccard(sets["a"], sets["h"]) >= 0.85 and jaccard(sets["a"], sets["b"]) >= 0.85 and jaccard(sets["b"], sets["d"]) >= 0.85
    assert max(jaccard(sets["b"], sets["h"]), jaccard(sets["a"], sets["d"]), jaccard(sets["h"], sets["d"])) < 0.79

    def bands(texts, sketch, documents, n, rows):
        met = {"h": (1, 2, 3, 4), "a": (1, 2, 3), "b": (1, 2, 5), "d": (5,), "other": (4,)} if rows == ROWS else {}
        nodes = spark.createDataFrame([(k, band) for k, own in met.items() for band in own], "k string, band long")
        names = spark.createDataFrame(list(all_texts.items()), "k string, text string")
        return nodes.join(names, "k").select("band", neardup._node("text"))

    all_texts = texts
    monkeypatch.setattr(neardup, "band_table", bands)
    docs = table(spark, list(texts.values()))
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}
    assert sorted(r["doc_id"] for r in keep_one_of_each(docs).collect()) == [0, 4]


def test_bounds_rule_out_most_pairs_of_a_group_below_the_threshold(spark):
    """Texts made of the lines of one, most of which no two share enough of; lines are said twice at times."""
    rng = random.Random(21)
    lines = [sentence(rng, 12) for _ in range(40)]
    texts = ["\n".join(x for x in lines for _ in range(rng.choice((1, 1, 2))) if rng.random() < 0.85) for _ in range(60)]
    texts += [texts[0] + "\nand some more words here", texts[1] + "\n" + lines[3]]
    names = table(spark, texts).select(neardup._node("text"), "text", "doc_id")
    docs = names.select("node", "text")
    cells = np.zeros((2, 1 << 18), np.int64)
    cells[:] = 10
    sketch = Sketch(cells)
    sets = []
    for t in texts:
        data, offsets = text_buffer(pa.array([t]))
        _, value, tf = distinct(*shingles(data, offsets))
        sets.append((value, neardup.weights(value, tf, sketch, 100)))
    nobody = spark.createDataFrame([], "node binary, leader binary, similarity double")
    bounds = neardup._bounds(nobody, docs, sketch, 100).join(names.select("node", "doc_id"), "node")
    met = bounds.alias("a").join(bounds.alias("b"), F.col("a.doc_id") < F.col("b.doc_id"))
    left = {tuple(r) for r in met.filter(neardup._possible(0.8)).select("a.doc_id", "b.doc_id").collect()}
    n = len(texts)
    similar = {(i, j) for i in range(n) for j in range(i + 1, n) if weighted_jaccard(sets[i], sets[j]) >= 0.8}
    assert similar and similar <= left and len(left) <= len(similar) + 30


def test_parity_marks_count_no_more_than_what_differs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 5000):
        hashes = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        a, b = rng.integers(0, 4, len(hashes)), rng.integers(0, 4, len(hashes))
        row = np.repeat([0, 2], [len(hashes)] * 2)  # a row without shingles between them
        marks = neardup.parity_marks(row, np.concatenate([hashes, hashes]), np.concatenate([a, b]), 3)
        assert marks.shape == (3, neardup.MARK_WORDS) and not marks[1].any()
        differing = int(np.bitwise_count((marks[0] ^ marks[2]).view(np.uint64)).sum())
        assert differing <= np.abs(a - b).sum() and (n != 50 or differing > 0.8 * np.abs(a - b).sum())


def test_one_of_each_class_where_classes_share_a_key(spark):
    texts = ["first text without a key", "second one, of other words", "alpha beta gamma", "delta epsilon", "delta epsilon", "zeta eta"]
    docs = table(spark, texts, [None, None, 7, 7, 7, 8])
    kept = [(r["doc_id"], r["text"]) for r in keep_one_of_each(docs).collect()]
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in {*zip([None, None, 7, 7, 7, 8], texts)})
    rng = random.Random(8)
    base = sentence(rng, 200)
    near = table(spark, [base, base + " more", base + " end", base], [None, None, None, None])
    assert keep_one_of_each(near).count() == 1


def test_samples_agree_as_often_as_weighted_similarity_says():
    rng = np.random.default_rng(2)
    hashes = np.sort(rng.integers(0, 1 << 63, 600, np.uint64))
    weight = rng.uniform(0.5, 3, 600).astype(np.float32)
    changed = np.where(rng.random(600) < 0.3, weight * rng.uniform(0.3, 2, 600), weight).astype(np.float32)
    keep = rng.random(600) < 0.9
    true = weighted_jaccard((hashes, weight), (hashes[keep], changed[keep]))
    exact = np.minimum(weight, np.where(keep, changed, 0)).sum() / np.maximum(weight, np.where(keep, changed, 0)).sum()
    assert abs(true - exact) < 1e-5
    agree = []
    for salt in range(40):
        mixed = hashes ^ np.uint64(salt * 0x1234567)
        order, order_b = np.argsort(mixed), np.argsort(mixed[keep])
        a = signatures(np.zeros(600, int), mixed[order], weight[order], BANDS * ROWS)[1]
        b = signatures(np.zeros(int(keep.sum()), int), mixed[keep][order_b], changed[keep][order_b], BANDS * ROWS)[1]
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - true) < 0.04


def test_components_of_a_chain(spark):
    edges = spark.range(60).select(F.encode(F.lpad((F.col("id") * 7 % 61).cast("string"), 3, "0"), "utf-8").alias("node"),
                                   F.encode(F.lpad(((F.col("id") + 1) * 7 % 61).cast("string"), 3, "0"), "utf-8").alias("leader"))
    rows = components(edges).collect()
    assert len(rows) == 61 and {bytes(r["label"]) for r in rows} == {b"000"}


# ---- quality -----------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    ws = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    inside = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines)


def test_quality_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = Q.op5_quality_rules(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dup, repeat, _ = brute_measures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])


@pytest.mark.parametrize("text", ["", "  ", "a b c a b c", "a a a a", "x\n\nx\n \n \nx", "é\x1fè é\x1fè\x0b", "#*$%&|<> a",
                                  "p q r s p q r", "w " * 50_000])
def test_measures(text):
    assert quality.measure_text(text) == brute_measures(text)


def test_binomial_bounds():
    for k, n, error in ((0, 50, 0.05), (3, 200, 0.01), (10, 40, 0.1), (5, 5, 0.05)):
        bound = quality.upper_bound(k, n, error)
        exact = sum(math.comb(n, i) * bound**i * (1 - bound) ** (n - i) for i in range(k + 1))
        assert bound == 1.0 if k == n else abs(exact - error) < 1e-9
    assert abs(quality.upper_bound(0, 100, 0.05) - (1 - 0.05 ** (1 / 100))) < 1e-9


def test_cutoffs_keep_their_promise():
    """Over many draws, a cutoff that truly rejects more than allowed is chosen no more often than the error says."""
    rng, broken = np.random.default_rng(4), 0
    for _ in range(300):
        good = np.bincount(rng.geometric(0.05, 1500).clip(0, quality.GRID), minlength=quality.GRID + 1)
        cell = quality.choose_cell(good, list(range(200, 0, -5)), 0.05, 0.1)
        broken += cell is not None and 0.95**cell > 0.05
    assert broken <= 300 * 0.1 + 15


def test_quality_edge_rows(spark):
    good = " ".join(f"word{i}" for i in range(80))
    bad = " ".join(f"word{i}###" for i in range(80))
    texts = [good] * 1500 + [bad] * 300 + [None, "", "few words"]
    ids = [*range(1800), None, 1800, 1801]
    docs = table(spark, texts, ids)
    labels = spark.createDataFrame([(i, int(i < 1500), "x") for i in range(1800)] + [(None, 1, "y"), (5, None, "z")],
                                   "doc_id bigint, quality int, stratum string")
    rows = quality.judge_quality(docs, labels).collect()
    assert len(rows) == len(texts)
    assert all(r["kept"] for r in rows if r["doc_id"] is not None and r["doc_id"] < 1500)
    assert not any(r["kept"] for r in rows if r["doc_id"] is None or r["doc_id"] >= 1500)
    plain = quality.judge_quality(docs, labels.limit(0)).filter("kept = base_failed").count()
    assert plain == 0 and quality.judge_quality(docs.limit(0), labels).count() == 0


def test_strata_beyond_the_largest_share_cutoffs(spark):
    good, bad = " ".join(f"word{i}" for i in range(80)), " ".join(f"word{i}###" for i in range(80))
    rows = [(i, good if i % 6 else bad, "big" if i < 2400 else f"tag{i % 40}") for i in range(4800)]
    rows += [(5000, bad, "never labelled"), (5001, good, "never labelled")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 6 > 0)) for i in range(4800)], "doc_id bigint, quality int")
    judged = quality.judge_quality(docs, labels, max_strata=1).collect()
    assert len(judged) == len(rows) and not any(r["base_failed"] for r in judged)
    texts = {i: t for i, t, _ in rows}
    assert all(r["kept"] == (texts[r["doc_id"]] == good) for r in judged)


# ---- toxicity ----------------------------------------------------------------------------------


def toxic_table(spark, n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        bad = rng.random() < 0.2
        text = sentence(rng, rng.randrange(5, 200)).split()
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(("vile", "filthy")) + rng.choice(("", "er", "ing")))
        rows.append((i, " ".join(text), *ROW, int(bad)))
    return spark.createDataFrame(rows, DOCS + ", truth int")


def test_toxicity_on_held_out_documents(spark):
    docs = toxic_table(spark, 1200, 1)
    labels = docs.filter("doc_id < 800").select("doc_id", F.col("truth").alias("toxic"), F.lit(1).alias("quality"))
    chain = toxicity.train_toxicity(docs, labels)
    judged = toxicity.judge_toxicity(docs, chain).join(docs.select("doc_id", "truth"), "doc_id").filter("doc_id >= 800").collect()
    assert len(judged) == 400
    assert sum(r["rejected"] for r in judged if r["truth"]) >= 0.97 * sum(r["truth"] for r in judged)
    assert sum(r["rejected"] for r in judged if not r["truth"]) <= 2
    kept = toxicity.drop_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in toxicity.judge_toxicity(docs, chain).filter("not rejected").collect()}


def test_toxicity_of_the_test_table(spark):
    """Accuracy on labelled documents that the models did not see."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    chain = toxicity.train_toxicity(docs, labels.filter(seen))
    judged = toxicity.judge_toxicity(docs, chain).join(labels.filter(~seen), "doc_id").groupBy("toxic", "rejected").count().collect()
    n = {(r["toxic"], r["rejected"]): r["count"] for r in judged}
    assert n.get((0, True), 0) <= 0.005 * n[0, False]
    assert n[1, True] >= 0.9 * (n[1, True] + n.get((1, False), 0))


def test_toxicity_edge_rows(spark):
    docs = table(spark, [None, "", "vile", "vile", "fine " * 60_000], [1, 2, 3, 3, None])
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    for labels in (nothing, spark.createDataFrame([(1, None, None), (3, 0, 1), (3, 0, 0), (None, 1, 1)], nothing.schema)):
        chain = toxicity.train_toxicity(docs, labels)
        assert toxicity.drop_toxic(docs, chain).count() == 5
        assert toxicity.judge_toxicity(docs.limit(0), chain).count() == 0


def test_later_models_get_out_of_fold_probabilities():
    rng = np.random.default_rng(6)
    hits = [([int(x)], [0.0] * toxicity.MEASURES) for x in rng.integers(0, 4, 400)]
    first = np.array([h[0][0] < 2 for h in hits])
    labels = np.column_stack([first, first]).astype(int)
    chain = toxicity.fit_chain(hits, labels, np.arange(400) % 5, dict.fromkeys("abcd", 1.0), ["one", "two"])
    assert [len(w) - toxicity.MEASURES for w in chain.weights] == [5, 6]  # features, earlier probabilities, intercept
    found = chain.probabilities([([x], [0.0] * toxicity.MEASURES) for x in (0, 3)])
    assert found[0, 1] > 0.9 and found[1, 1] < 0.1
    assert distinct(np.array([0, 0]), np.array([2, 2], np.uint64))[2].tolist() == [2]
