"""Chunked encoding against the tokenizer's own library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from pulse.llm import queries as Q
from pulse.llm.bpechunks import LARGEST, SMALLEST, WordBpe, chunks, encode_documents, joined, vocabulary_path

SMALL = "/root/testdata/sf0.001"
ROWS = "doc_id bigint, text string, n_tokens string, ids string, packed string, number int, n int"
LONG = " ".join(f"Sentence number {i}, it's ünïcode; don't <|endoftext|> 日本語 {i * 7919}." for i in range(3000))
STRANGE = [
    None, "", " ", "a", "Hello, World!", "x" * 30000, "don't we'll " * 500, "日本語のテキスト" * 900, "é" * 4000, "́ ́a " * 900,
    "a<|endoftext|>B<|startoftext|> <|ENDOFTEXT|><|endof text|>" * 90, "\x1c\x1d\x85　\xa0 word\x0b\x0c\t\r\n" * 200, "12345 67890 " * 700,
    "!!!???...---" * 800, "İstanbul ΑΣ ς ŉ ǅ ﬁ K Å Ω " * 300, "word\n" * 9000, "👩‍👩‍👧 🇩🇪 " * 700, "\0 a\0b", LONG, LONG[1000:], "prefix " + LONG,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))


def test_strange_texts_nulls_and_repeated_rows(spark, library):
    texts = STRANGE + ["Hello, World!", None]
    ids = [*range(len(texts) - 3), None, None, 3]
    given = spark.createDataFrame([(i, t, "x", "y", "z", 1, 2) for i, t in zip(ids, texts)], ROWS)
    found = encode_documents(given).collect()
    rows = sorted(((r[0], tuple(r)[1:]) for r in found), key=str)
    assert rows == sorted(((i, expected(library, t)) for i, t in zip(ids, texts)), key=str)


def test_kept_ids_and_empty_table(spark, library):
    given = spark.createDataFrame([(1, LONG, "", "", "", 1, 2), (2, LONG + " end", "", "", "", 1, 2)], ROWS)
    kept = {r["doc_id"]: r["ids"] for r in encode_documents(given, keep_ids=True).collect()}
    assert kept == {1: library.encode(LONG, add_special_tokens=False).ids, 2: library.encode(LONG + " end", add_special_tokens=False).ids}
    assert encode_documents(given.limit(0)).count() == 0


def test_the_query_on_the_test_table(spark, library):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = Q.op11_bpe_encoding(spark, SMALL)
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "string", "string"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {r[0]: expected(library, r[1]) for r in table}


@pytest.mark.parametrize("seed", range(6))
def test_joins_anywhere_are_repaired(library, seed):
    rng, bpe = random.Random(seed), WordBpe.at(vocabulary_path())
    alphabet = ["word", "It's", "'", "s", " ", "\n", "é", "é", "日本", "1", "23", "!", "<|endoftext|>", "<|", "  ", "x" * 40]
    text = "".join(rng.choice(alphabet) for _ in range(400)).encode()
    cuts = sorted(c for c in {0, len(text), *(rng.randrange(len(text)) for _ in range(60))} if c == len(text) or text[c] & 0xC0 != 0x80)
    places = list(zip(cuts, cuts[1:]))
    ids = joined(bpe, text, places, [bpe.encode(text[a:b]) for a, b in places])
    assert np.frombuffer(ids, "<u2").tolist() == library.encode(text.decode(), add_special_tokens=False).ids


@pytest.mark.parametrize("unit", ["x", "日本語。", "ab1,", "dünn"])
def test_long_texts_without_blanks_are_encoded_once(library, unit):
    rng, bpe = random.Random(unit), WordBpe.at(vocabulary_path())
    text = "".join(unit if rng.random() < 0.9 else rng.choice("abcdefgh.;é") for _ in range(400_000 // len(unit)))
    text = (text + " end of it, and on it goes. " * 400 + text).encode()
    places, encoded = chunks(text), []
    assert len(places) > 60
    parts = [bpe.encode(text[a:b]) for a, b in places]
    original = bpe.encode
    bpe.encode = lambda piece: encoded.append(len(piece)) or original(piece)
    try:
        ids = joined(bpe, text, places, parts)
    finally:
        del bpe.encode
    assert np.frombuffer(ids, "<u2").tolist() == library.encode(text.decode(), add_special_tokens=False).ids
    assert sum(encoded) < 3 * len(text)


def test_plain_characters_are_taken_apart_like_the_vocabulary_does(library):
    bpe, rng = WordBpe.at(vocabulary_path()), random.Random(9)
    plain = [chr(c) for c in range(0x180)]
    for _ in range(300):
        text = "".join(rng.choice(plain) if rng.random() < 0.5 else rng.choice("ab's 1.'tre'llÉß") for _ in range(60))
        assert np.frombuffer(bpe.encode(text.encode()), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_the_table_of_pieces_is_bounded(library, monkeypatch):
    import pulse.llm.bpechunks as module

    monkeypatch.setattr(module, "PIECES_KEPT", 50)
    bpe = WordBpe(vocabulary_path())
    for i in range(30):
        text = " ".join(f"wörd{chr(97 + i % 26)}{chr(97 + j)}" for j in range(26)) + "y" * 100
        assert np.frombuffer(bpe.encode(text.encode()), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(bpe._words) <= 50


def test_chunks_follow_the_content():
    text = LONG.encode()
    places = chunks(text)
    assert b"".join(text[a:b] for a, b in places) == text and places[0][0] == 0
    assert all(b - a <= LARGEST for a, b in places) and all(b - a >= SMALLEST - 3 for a, b in places[:-1])
    shifted = chunks(b"some other beginning. " * 40 + text)
    own, other = ({(b"some other beginning. " * 40 + text)[a:b] for a, b in shifted}, {text[a:b] for a, b in places})
    assert len(own & other) > 0.9 * len(other)
    assert chunks(b"") == [(0, 0)] and all(a < b for a, b in chunks("日".encode() * 9000))
    big = (LONG * 15).encode()
    assert b"".join(big[a:b] for a, b in chunks(big)) == big and len(big) > 3 << 20
