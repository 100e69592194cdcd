"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Every text is measured once. Rules compare a measurement with a cutoff. A cutoff may only be
used if labelled good documents show that it rejects few of them: for each stratum (a
language) and rule, candidate cutoffs go from the loosest to the tightest, and each is
tested on the holdout with the exact (Clopper-Pearson) upper bound on the share of good
documents it rejects. The bound must be at most ``max_false_rejection``. Testing stops at the
first failure, so the order needs no correction (fixed-sequence testing); the stratum-rule
pairs share the error probability ``delta`` equally (Bonferroni). With probability 1 - delta
all chosen cutoffs keep their promise. Where no cutoff passes, the rule rejects nothing.

The labelled documents are split by a hash: from one half come the candidate cutoffs
(quantiles of the bad documents' measurements), the other half is the holdout. Both enter as
counts on a fixed grid of values, so all labelled rows count and the driver sees at most
strata x rules x grid rows. All strata but the ``max_strata`` with most labelled rows share
one: their counts are added up, and its cutoffs hold for each of them, labelled or not.

Defined cases: a null or empty text has no words and fails the base rule; a document
without label, or with a null one, is not used for cutoffs; a document labelled twice counts
twice; a null stratum is one of its own; without labels nothing but the base rule
rejects; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pulse.llm.shared import written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = str.maketrans("", "", "#*$%&|<>")
_BLANK = str.maketrans("", "", " \t\n\v\f\r")
#: Cells of the grid on which the values of a rule are counted.
GRID = 400
#: Stands for all strata that have none of their own.
OTHERS = object()


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose ``value`` is above the cutoff; ``top`` is the value of the last grid cell."""

    name: str
    value: str
    top: float


#: Values are SQL over the measures, all the larger the worse.
RULES = (
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", 4.0),
    Rule("duplicate_line_share", "n_dup_lines / greatest(n_lines, 1)", 1.0),
    Rule("repeated_word_share", "n_repeat_words / greatest(n_words, 1)", 1.0),
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 20.0),
    Rule("brevity", "50 / greatest(n_words, 1)", 1.0),
)


def measure_text(text: str) -> tuple[int, ...]:
    """``MEASURES`` of one text; bytes.split() parts at exactly the six ASCII blanks."""
    words = text.encode().split()
    if not words:
        return (0,) * len(MEASURES)
    lines = [line for line in text.split("\n") if line.translate(_BLANK)]
    return (len(words), len(text.translate(_BLANK)), len(text) - len(text.translate(SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) < 1 << 21:
        codes = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:  # more distinct words than fit three times into 63 bits: number the pairs first
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        codes = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    same = ordered[1:] == ordered[:-1]
    repeated = np.zeros(len(codes), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(repeated)] |= repeated
    return int(inside.sum())


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``key, stratum`` and the measures of every row."""
    fields = [docs.schema[key], StructField("stratum", StringType()), *(StructField(m, LongType()) for m in MEASURES)]

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure_text(value.as_py() or "") for value in batch.column(2)]
            values = np.array(rows, np.int64).reshape(-1, len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, values)],
                                             [f.name for f in fields])

    texts = docs.select(key, F.col(stratum).cast("string").alias("stratum"), F.col(text).cast("string"))
    return texts.mapInArrow(measured, StructType(fields))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


# ---- cutoffs -----------------------------------------------------------------------------------


def binomial_tail(rejected: int, n: int, share: float) -> float:
    """P(X <= rejected) for X ~ Binomial(n, share), summed exactly in logarithms."""
    if share <= 0:
        return 1.0
    if share >= 1:
        return 1.0 if rejected >= n else 0.0
    x = np.arange(rejected + 1)
    gamma = np.array([math.lgamma(v + 1) for v in range(n + 1)]) if n < 100_000 else None
    log_of = (lambda v: gamma[v]) if gamma is not None else np.vectorize(lambda v: math.lgamma(v + 1))
    terms = math.lgamma(n + 1) - log_of(x) - log_of(n - x) + x * math.log(share) + (n - x) * math.log1p(-share)
    return float(min(1.0, np.exp(terms - terms.max()).sum() * math.exp(terms.max())))


def upper_bound(rejected: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest share that the count does not rule out at this error probability."""
    if rejected >= n:
        return 1.0
    low, high = rejected / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(rejected, n, middle) > error else (low, middle)
    return high


def choose_cell(good: np.ndarray, candidates: list[int], max_share: float, error: float) -> int | None:
    """The tightest grid cell reached before the first candidate that fails; values in later cells are rejected.

    ``good`` counts the holdout's good documents by cell; candidates go from loose to tight.
    """
    total, chosen = int(good.sum()), None
    for cell in candidates:
        rejected = int(good[cell + 1 :].sum())
        if total == 0 or rejected > max_share * total or binomial_tail(rejected, total, max_share) > error:
            break
        chosen = cell
    return chosen


def _cell(rule: Rule) -> Column:
    return F.least(F.ceil(F.expr(rule.value) * (GRID / rule.top)), F.lit(GRID)).cast("int")


def choose_cutoffs(
    measured: DataFrame, labels: DataFrame, key: str, label: str = "quality", rules=RULES,
    max_false_rejection: float = 0.02, delta: float = 0.05, max_strata: int = 64,
) -> dict[tuple[str | object | None, str], int]:
    """Grid cells by (stratum, rule), ``GRID`` where a rule rejects nothing.

    ``None`` in a key's stratum is the null stratum, ``OTHERS`` what the strata that are not listed share.
    """
    judged = labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("good")).filter("good IN (0, 1)")
    # Labels are fewer than documents; a label of a document that is listed twice applies to both rows.
    rows = measured.filter(~base_failed()).join(judged, F.col(key) == F.col("__id"))
    half = F.pmod(F.xxhash64(F.lit("half"), key), F.lit(2)).cast("int")
    cells = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), _cell(r).alias("cell")) for r in rules]))
    counts = rows.select("stratum", "good", half.alias("half"), cells.alias("c")).groupBy(
        "stratum", "good", "half", "c.rule", "c.cell"
    ).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.filter(F.col("rule") == rules[0].name).groupBy("stratum").agg(F.sum("n").alias("size"))
    largest = sizes.orderBy(F.desc("size"), "stratum").limit(max_strata).select(
        F.col("stratum").alias("named"), F.lit(True).alias("own"))
    shared = counts.join(F.broadcast(largest), F.col("stratum").eqNullSafe(F.col("named")), "left").fillna(False, ["own"])
    kept = shared.groupBy("own", "named", "good", "half", "rule", "cell").agg(F.sum("n").alias("n")).collect()
    grids: dict[tuple, np.ndarray] = {}
    for r in kept:
        name = r["named"] if r["own"] else OTHERS
        grid = grids.setdefault((name, r["rule"]), np.zeros((2, 2, GRID + 1), np.int64))
        grid[r["good"], r["half"], max(0, r["cell"])] += r["n"]
    chosen = {}
    for pair, grid in grids.items():
        bad = np.repeat(np.arange(GRID + 1), grid[0, 0])
        # Cutoffs just below quantiles of the bad documents, loose ones first.
        wanted = {max(0, int(np.quantile(bad, q)) - 1) for q in np.linspace(0.05, 0.95, 19)} if len(bad) else set()
        cell = choose_cell(grid[1, 1], sorted(wanted, reverse=True), max_false_rejection, delta / len(grids))
        chosen[pair] = GRID if cell is None else cell
    return chosen


def judge_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", rules=RULES,
    **options,
) -> DataFrame:
    """``key, stratum``, measures, ``base_failed, failed_rules, kept`` of every row.

    Texts are measured once and the measures written; cutoffs and verdicts read those.
    """
    measured = written(measure(docs, key, text, stratum), "measures")
    cutoffs = choose_cutoffs(measured, labels, key, rules=rules, **options)
    fails = []
    for rule in rules:
        strata = [(s, cell) for (s, name), cell in cutoffs.items() if name == rule.name and s is not OTHERS]
        limit = F.lit(cutoffs.get((OTHERS, rule.name), GRID))
        for name, cell in strata:
            limit = F.when(F.col("stratum").eqNullSafe(F.lit(name)), cell).otherwise(limit)
        fails.append(F.when(_cell(rule) > limit, F.lit(rule.name)))
    judged = measured.withColumn("base_failed", base_failed()).withColumn(
        "failed_rules", F.array_compact(F.array(*fails))
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
