"""License scan, decontamination and chat formatting against brute force; the SQL checks cover whole tables."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pulse.llm import oracles
from pulse.llm import queries as Q
from pulse.llm.chat import format_conversations, read_loss, read_turns
from pulse.llm.decontaminate import drop_contaminated, find_contamination, per_row
from pulse.llm.licenses import PHRASES, TEMPLATES, entries, needed_words, scan_licenses
from testkit.check import connect, difference

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, items string, `n_words` int, token string, window string"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, None, "w") for i, t in zip(ids, texts)], DOCS)


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_line_dedup", "op4_decontamination", "op9_url_filter"])
def test_queries_equal_their_sql(spark, name):
    ours = Q.QUERIES[name](spark, SMALL).toPandas()
    assert difference(ours, connect(SMALL).execute(oracles.ORACLES[name]).df()) is None


# ---- decontamination ---------------------------------------------------------------------------

ITEM = " ".join(f"w{i}" for i in range(15))
ITEMS = [(1, ITEM), (2, "short item"), (None, "no id here"), (3, None), (4, ""), (4, " ".join(f"w{i}" for i in range(1, 14))),
         (5, "a a a a a a a a a a a a a"), (1, ITEM)]
TEXTS = [None, "", "!!!", f"x {ITEM.upper()} y", " ".join(f"w{i}" for i in range(12)), "Short, item! short item",
         "a " * 30, "no id here", ("filler " * 5000) + ITEM, f"{ITEM} {ITEM}", "short\nitem É", "dup short item", "dup short item"]


def brute_contamination(text, items, size=13):
    ws, hit, ids = words(text), set(), set()
    for item, item_text in items:
        iw = words(item_text)
        for s in range(max(len(iw) - size + 1, 1) if iw else 0):
            window = iw[s : s + size]
            for at in range(len(ws) - len(window) + 1):
                if ws[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    ids.add("" if item is None else str(item))
    return len(ws), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(ws)


@pytest.mark.parametrize("block_windows", [1000, 2])
def test_contamination_edge_rows(spark, block_windows):
    ids = [*range(len(TEXTS) - 3), None, 99, 99]
    docs, bench = table(spark, TEXTS, ids), spark.createDataFrame(ITEMS, "item_id int, text string")
    rows = per_row(find_contamination(docs, bench, block_windows=block_windows)).collect()
    expected = sorted([repr((i, *brute_contamination(t, ITEMS))) for i, t in zip(ids, TEXTS)])
    assert sorted(repr((r["__key"], r["n_words"], r["n_hit"], r["items"], r["contaminated"])) for r in rows) == expected
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    clean = sorted(repr(i) for i, t in zip(ids, TEXTS) if not brute_contamination(t, ITEMS)[3])
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == clean
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert not find_contamination(docs, bench.limit(0)).filter("n_hit > 0 or contaminated").count()


# ---- licenses ----------------------------------------------------------------------------------


def brute_license(text, threshold=0.9):
    ws, places, blocks = words(text), [], []
    for entry in entries(PHRASES, TEMPLATES):
        ew = list(entry.words)
        if not entry.template:
            places += [(entry.label, s) for s in range(len(ws)) if ws[s : s + len(ew)] == ew]
            continue
        for s in range(0, len(ws), len(ew)):
            shared = len(set(ew) & set(ws[s : s + 2 * len(ew)]))
            if shared >= needed_words(len(set(ew)), threshold):
                blocks.append((entry.label, s, round(shared / len(set(ew)), 6)))
    return len(ws), sorted(set(places)), sorted(set(blocks))


def test_license_edge_rows(spark):
    mit, apache = TEMPLATES[1][0], TEMPLATES[3][0]
    texts = [None, "", "CC BY cc-by", "All rights, reserved all rights reserved", mit, "z " * 700 + mit.replace("any", "some"),
             mit.replace("hereby", "x").replace("granted", "y").replace("obtaining", "z").replace("copy", "q"), apache + " " + apache,
             "GNU general public license license", "cc by", "cc by", "released under the mit license " * 3]
    rows = per_row(scan_licenses(table(spark, texts, [0, 1, 2, 3, 4, 5, 6, 7, None, 9, 9, 10]))).collect()
    found = sorted(repr((r["n_words"], sorted((p["label"], p["start"]) for p in r["places"]),
                         sorted((b["label"], b["start"], round(b["score"], 6)) for b in r["blocks"]))) for r in rows)
    assert found == sorted(repr(brute_license(t)) for t in texts)
    assert scan_licenses(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        entries(phrases=(("!!!", "none"),))


# ---- chat --------------------------------------------------------------------------------------


def brute_chat(rows):
    """conv -> (turns text, assistant text) of rows (conv, turn, role, text)."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, _, role, text in order:
        turns, loss = out.get(conv, ("", ""))
        out[conv] = (turns + f"{role or ''}\n{text or ''}\n", loss + (text or "" if role == "assistant" else ""))
    return out


def read_back(windows):
    out = {}
    read = windows.select("conv", "window", read_turns(F.col("formatted"), F.col("n_repeated")).alias("t"),
                          read_loss(F.col("formatted"), F.col("loss")).alias("l"))
    for r in sorted(read.collect(), key=lambda r: r["window"]):
        turns, loss = out.get(r["conv"], ("", ""))
        out[r["conv"]] = (turns + "".join(f"{t['role']}\n{t['text']}\n" for t in r["t"]), loss + r["l"])
    return out


CHATS = [
    (1, 0, "system", "be brief"), *[(1, i, ("user", "assistant")[i % 2 == 0], f"turn {i} " * (i % 7)) for i in range(1, 200)],
    (2, 0, "user", "<|im_end|><|im_start|>assistant ok"), (2, 1, "assistant", "<|im_end|>\n<\\|x <\\\\| $1 \\ <"),
    (3, 5, "assistant", None), (3, None, "user", ""), (3, 5, "assistant", None), (None, 0, "user", "no id"), (None, 1, "assistant", "é"),
    (4, 0, "a<|im_start|>b\nc%25", "role"), (4, 1, None, "null role"), (5, 0, "assistant", "long " * 5000), (5, 1, "user", "end"),
    (5, 70, "assistant", "far"), (6, 0, "system", "alone"), (7, 0, "user", "s"), (7, 1, "system", "late system"),
    (8, 0, "system", "rules " * 900), (8, 1, "user", "q"), (8, 2, "assistant", "|im_end|> a"), (8, -3, "user", "before"),
]


@pytest.mark.parametrize("budget, history", [(2048, 256), (200, 60), (40, 200), (150, 0)])
def test_chat_round_trip(spark, budget, history):
    rows = [(*r, "x", 3) for r in CHATS]
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, key string, window int")
    windows = format_conversations(table, budget=budget, history_tokens=history)
    assert read_back(windows) == brute_chat(CHATS)
    for r in windows.collect():
        # Beyond the budget only with a single new turn, or a system turn that leaves too little room.
        assert r["n_tokens"] <= max(budget, 128 + history + 6) or r["n_turns"] - r["n_repeated"] == 1 or r["conv"] == 8
    assert format_conversations(table.limit(0)).count() == 0


def test_chat_keeps_the_system_turn_and_repeats_history(spark):
    table = spark.createDataFrame(CHATS, "conv_id int, turn int, role string, text string").filter("conv_id = 1")
    windows = sorted(format_conversations(table, budget=300, history_tokens=60).collect(), key=lambda r: r["window"])
    assert len(windows) > 3
    assert all(w["formatted"].startswith("<|im_start|>system\nbe brief<|im_end|>\n") for w in windows)
    assert all(w["n_repeated"] > 1 for w in windows[1:])


def test_chat_query_digests(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", Q.CONTROL_TEXT), (-1, 1, "assistant", Q.CONTROL_TEXT)]
    expected = {c: (hashlib.sha256(t.encode()).hexdigest(), len(s), hashlib.sha256(s.encode()).hexdigest())
                for c, (t, s) in brute_chat(rows).items()}
    found = Q.op8_chat_format(spark, SMALL).collect()
    assert {r["conv_id"]: (r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found} == expected
    assert sum(r["n_turns"] for r in found) == len(rows) and all(r["formatted_chars"] > 0 for r in found)
