"""License notices in documents: exact phrases, and templates by exact set containment.

A phrase is found where its words stand in order. A template is a set of words; a text
block contains it if it holds at least ``threshold`` of them. Blocks of a template of m words
are 2m words long and begin at every m-th word, so that any run of m words lies in one.

Both are found by one prefix-filtered join. The words of a phrase or template are ordered
by rarity over all documents. A block that misses no more words than the threshold allows
must hold one of the (m - needed + 1) rarest, so only these are joined; a phrase needs its
rarest alone. A meeting leads to the blocks around the word; the length bound (block and
template have enough words) and the positional bound (enough words of the template follow
the token in its order) go before the intersection, which is exact.

Phrases and templates are program parameters of at most ``LIMIT_WORDS`` words together, which
bounds the broadcast and the vocabulary whose counts the driver orders.

Defined cases: a null or empty text has no words and no labels; overlapping and repeated
places all count; equal rows each get their own result; an empty table gives an empty
result. Only key and text are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.words import BREAKS, IDENTITY, count_words, probe_words, window_occurs, window_start

LIMIT_WORDS = 20_000
THRESHOLD = 0.9
ENTRY = ("token string, label string, window array<string>, n int, offset int, template boolean, needed int, "
         "span int, place int")

# Phrases with their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Notices of public licenses.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis without warranties or conditions of any kind", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


@dataclass(frozen=True)
class Entry:
    """A phrase or template with its words; ``tokens`` are distinct words, rarest first."""

    label: str
    words: tuple[str, ...]
    template: bool

    def tokens(self, counts: dict[str, int]) -> list[str]:
        return sorted(set(self.words), key=lambda word: (counts.get(word, 0), word))

    def rows(self, counts: dict[str, int], threshold: float) -> list[tuple]:
        tokens = self.tokens(counts)
        if not self.template:
            return [(tokens[0], self.label, list(self.words), len(self.words), self.words.index(tokens[0]), False, 0, 1, 0)]
        needed = needed_words(len(tokens), threshold)
        prefix = tokens[: len(tokens) - needed + 1]
        return [(token, self.label, tokens, len(tokens), 0, True, needed, len(self.words), place)
                for place, token in enumerate(prefix)]


def needed_words(n: int, threshold: float) -> int:
    return math.ceil(n * threshold - 1e-9)


def entries(phrases=PHRASES, templates=TEMPLATES) -> list[Entry]:
    split = re.compile(BREAKS)
    made = [Entry(label, tuple(w for w in split.split(text) if w), template)
            for listed, template in ((phrases, False), (templates, True)) for text, label in listed]
    if sum(len(e.words) for e in made) > LIMIT_WORDS or not all(e.words for e in made):
        raise ValueError(f"phrases and templates must have words, {LIMIT_WORDS} at most together")
    return made


def _literal_table(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    names = [field.split()[0] for field in ENTRY.split(", ")]
    structs = [F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(n) for n, v in zip(names, row)])
               for row in rows]
    return docs.sparkSession.range(1).select(F.inline(F.array(*structs)))


def _block_score(block: Column) -> Column:
    """Share of the template's words in a block; null below the threshold or beyond the text."""
    begin = block * F.col("span")
    length = F.least(F.size("__words") - begin, F.col("span") * 2)
    possible = F.least(F.col("n") - F.col("place"), length)  # positional and length bound
    words = F.slice("__words", F.greatest(begin, F.lit(0)) + 1, F.col("span") * 2)
    shared = F.size(F.array_intersect("window", words))
    enough = F.when((block >= 0) & (possible >= F.col("needed")), shared >= F.col("needed")).otherwise(False)
    return F.when(enough, shared / F.col("n"))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: identity, ``n_words, copies``, ``places`` and ``blocks``.

    ``places``: ``(label, start)`` of every phrase; ``blocks``: ``(label, start, score)`` of
    every block that contains a template. Starts count words from 0; ``copies`` is how
    many rows of the input the row stands for.
    """
    listed = entries(phrases, templates)
    vocabulary = sorted({word for entry in listed for word in entry.words})
    counted = count_words(docs, text, F.col("word").isin(vocabulary))
    counts = {r["word"]: r["n"] for r in counted.collect()}  # at most as many rows as the parameters have words
    index = _literal_table(docs, [row for entry in listed for row in entry.rows(counts, threshold)])

    met = probe_words(docs, key, text, index)
    block = F.floor((F.col("__at") - 1) / F.col("span")).cast("int")
    scored = met.select(
        "*", F.when(F.col("template"), _block_score(block)).alias("__here"),
        F.when(F.col("template"), _block_score(block - 1)).alias("__before"),
        F.when(~F.col("template"), window_occurs()).alias("__occurs"), block.alias("__block"),
    )
    whole = F.col("__at") == 0
    kept = scored.filter(whole | F.col("__occurs") | F.col("__here").isNotNull() | F.col("__before").isNotNull())

    def found(score: str, back: int) -> Column:
        start = (F.col("__block") - back) * F.col("span")
        return F.when(F.col(score).isNotNull(), F.struct("label", start.alias("start"), F.col(score).alias("score")))

    rows = kept.select(
        *IDENTITY, F.size("__words").cast("long").alias("n_words"), whole.cast("long").alias("whole"),
        F.when(F.col("__occurs"), F.struct("label", window_start().alias("start"))).alias("place_found"),
        found("__here", 0).alias("here"), found("__before", 1).alias("before"),
    )
    grouped = rows.groupBy(*IDENTITY).agg(
        F.max("n_words").alias("n_words"), F.sum("whole").alias("copies"), F.collect_set("place_found").alias("places"),
        F.collect_set("here").alias("here"), F.collect_set("before").alias("before"),
    )
    return grouped.select(*IDENTITY, "n_words", "copies", "places", F.array_union("here", "before").alias("blocks"))
