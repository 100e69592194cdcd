"""Words of a text and the search of ordered windows in them, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: all of ASCII but digits and lower-case letters.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. A text of ASCII alone takes the quicker function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """Words in order; a null or empty text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS), "")


def text_identity(key: str, text: str) -> list[Column]:
    """Rows with the same key and text have all results in common, so these four columns stand for a row."""
    value = F.col(text).cast("string")
    return [
        F.col(key).alias("__key"),
        F.xxhash64(value).alias("__hash1"),
        F.xxhash64(F.lit(1), value).alias("__hash2"),
        value.isNull().alias("__null"),
    ]


IDENTITY = ["__key", "__hash1", "__hash2", "__null"]


def probe_words(docs: DataFrame, key: str, text: str, index: DataFrame) -> DataFrame:
    """Each document's words against an index with a column ``token``, which must be small enough to broadcast.

    Gives one row per document with ``__at`` 0 and null index columns, and one for each
    word that meets an index row, where ``__at`` is the word's number from 1. ``__words``
    holds the whole document. All of it is one stage: a row that is filtered out right
    after this never leaves the generated code.
    """
    words = docs.select(*text_identity(key, text), word_array(F.col(text)).alias("__words"))
    # The empty word in front meets nothing and so leaves one row for each document.
    exploded = words.select("*", F.posexplode(F.concat(F.array(F.lit("")), F.col("__words"))).alias("__at", "__word"))
    joined = exploded.join(F.broadcast(index), F.col("__word") == F.col("token"), "left")
    return joined.filter((F.col("__at") == 0) | F.col("token").isNotNull())


def window_start() -> Column:
    """0-based first word of the window whose token at ``offset`` is the word met."""
    return F.col("__at") - F.lit(1) - F.col("offset")


def window_occurs() -> Column:
    """Whether the ``window`` of ``n`` words stands there: positional and length bound first, then word by word."""
    start = window_start()
    fits = (start >= 0) & (start + F.col("n") <= F.size("__words"))
    # slice() is evaluated for windows within bounds only; least() keeps its arguments valid for the others.
    at = F.greatest(start, F.lit(0)) + 1
    return F.when(fits, F.slice("__words", at, F.col("n")) == F.col("window")).otherwise(False)


def count_words(docs: DataFrame, text: str, only: Column) -> DataFrame:
    """``word, n`` over all documents for the words that the condition on ``word`` admits."""
    words = docs.select(F.explode(word_array(F.col(text))).alias("word")).filter(only)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
