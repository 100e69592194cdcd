"""Benchmark passages in documents, found exactly by a prefix-filtered join.

An item's windows are its runs of 13 words; an item of fewer words is one window. The
words of a window are ordered by rarity over all documents. For exact containment the
necessary prefix of that order is one token, so only the rarest word of each window is
joined to the words of the documents. A meeting says at which word the window would have
to start; it is a hit if that start lies in the document (positional bound), the window
ends in it (length bound) and all its words stand there in order.

Words are exploded, joined to the broadcast windows, checked and reduced to one row per
document in one stage; what is shuffled is a row per document with its hits. A window set
too large for one broadcast is dealt to several blocks of at most ``block_windows`` windows
of up to 13 words, each with its own pass over the documents.

Defined cases: a null or empty text has no words and no hits; an item without words has no
windows; a null item id counts as an empty one, an id listed twice as one; rows with equal
key and text all get the same result, each on its own row; empty tables give an empty
result or no hits. Only key and text are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.shared import written
from pulse.llm.words import IDENTITY, probe_words, window_occurs, window_start, word_array

WINDOW_WORDS = 13
#: Windows in one broadcast: with 13 words and their items, some 200 MB.
BLOCK_WINDOWS = 400_000
VOCABULARY_ROWS = 2_000_000


def benchmark_windows(benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """``window, items``: every distinct window with the ids of the items that have it."""
    words = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), word_array(F.col(text)).alias("words")
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(size - 1), F.lit(1)))
    windows = words.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start"), size).alias("window")
    )
    return windows.groupBy("window").agg(F.collect_set("item").alias("items"))


def rarest_token_index(windows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Each window with its rarest word, that word's place in it and a running number for blocks."""
    tokens = windows.select("window", "items", F.posexplode("window").alias("offset", "token"))
    vocabulary = tokens.select(F.col("token").alias("listed")).distinct()
    if vocabulary.count() <= VOCABULARY_ROWS:
        vocabulary = F.broadcast(vocabulary)
    words = docs.select(F.explode(word_array(F.col(text))).alias("word"))
    counts = words.join(vocabulary, F.col("word") == F.col("listed"), "left_semi").groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    rarity = F.struct(F.coalesce(F.col("n"), F.lit(0)), "token", "offset")
    rarest = tokens.join(counts, tokens["token"] == counts["word"], "left").groupBy("window").agg(
        F.first("items").alias("items"), F.min(rarity).alias("rarest")
    )
    return rarest.select(
        "window", "items", F.size("window").alias("n"), F.col("rarest.token").alias("token"),
        F.col("rarest.offset").alias("offset"),
    )


def covered_words(spans: Column) -> Column:
    """Words inside any of the spans ``(start, n)``, which are ordered by start."""
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))

    def add(seen: Column, span: Column) -> Column:
        end = F.greatest(seen["end"], span["start"] + span["n"])
        new = end - F.least(F.greatest(span["start"], seen["end"]), end)
        return F.struct((seen["words"] + new).alias("words"), end.alias("end"))

    return F.aggregate(F.sort_array(spans), zero, add, lambda seen: seen["words"])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", size: int = WINDOW_WORDS, hit_share: float = 0.05, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per document: ``__key`` and text hashes, ``n_words, n_hit, spans, items, contaminated, copies``.

    ``copies`` is how many rows of the input the row stands for.
    """
    index = written(rarest_token_index(benchmark_windows(benchmark, item, item_text, size), docs, text), "windows")
    blocks = max(1, -(-index.count() // block_windows))
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    found = [_hits(docs, key, text, index.filter(block == i) if blocks > 1 else index) for i in range(blocks)]
    hits = found[0]
    if blocks > 1:
        hits = reduce(DataFrame.unionByName, found).groupBy(*IDENTITY).agg(
            F.max("n_words").alias("n_words"), F.max("copies").alias("copies"),
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.flatten(F.collect_list("item_sets")).alias("item_sets"),
        )
    counted = hits.select(
        *IDENTITY, "n_words", "copies", "spans",
        F.when(F.size("spans") > 0, covered_words(F.col("spans"))).otherwise(0).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("item_sets"))).alias("items"),
    )
    many = F.col("n_hit") >= F.col("n_words") * F.lit(hit_share)
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & many)


def _hits(docs: DataFrame, key: str, text: str, index: DataFrame) -> DataFrame:
    met = probe_words(docs, key, text, index).filter((F.col("__at") == 0) | window_occurs())
    whole, hit = F.col("__at") == 0, F.col("__at") > 0
    rows = met.select(
        *IDENTITY, whole.cast("long").alias("whole"), F.size("__words").cast("long").alias("n_words"),
        F.when(hit, F.struct(window_start().alias("start"), "n")).alias("span"), F.when(hit, F.col("items")).alias("items"),
    )
    return rows.groupBy(*IDENTITY).agg(
        F.max("n_words").alias("n_words"), F.sum("whole").alias("copies"), F.collect_set("span").alias("spans"),
        F.collect_set("items").alias("item_sets"),
    )


def per_row(found: DataFrame) -> DataFrame:
    """One row for each row of the input again."""
    return found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")).drop("__copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = find_contamination(docs, benchmark, key, text, **options).filter("contaminated").select(*IDENTITY)
    same = [column.eqNullSafe(F.col(f"bad.{name}")) for column, name in
            zip(_docs_identity(key, text), IDENTITY)]
    return docs.alias("docs").join(bad.alias("bad"), reduce(Column.__and__, same), "left_anti")


def _docs_identity(key: str, text: str) -> list[Column]:
    value = F.col(f"docs.{text}").cast("string")
    return [F.col(f"docs.{key}"), F.xxhash64(value), F.xxhash64(F.lit(1), value), value.isNull()]
