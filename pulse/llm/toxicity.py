"""Toxicity by a classifier chain of linear models.

Categories are conditions on the label columns and have an order. The model of each is a
logistic regression over word features and the probabilities of all categories before it.
In training these are out-of-fold: a document's probability comes from a model that was
fitted without the document's fold, so later models see earlier ones as they behave on new
texts. The last category decides; its threshold maximises F1 of the
out-of-fold probabilities and is one half at least.

Features are the distinct words of a text and their first 3 to 6 characters, so inflected
forms share a stem. The ``MAX_FEATURES`` that speak most for a toxic text are kept, each with the
lower confidence limit of its log odds. Three measures of a text join them: the strongest
word, the sum over distinct words and the sum over all words for each hundred.

Fitting uses a bounded sample, the ``MAX_LABELLED`` labelled documents whose ids have the
smallest hashes: their texts are written once, the feature counts are aggregated by Spark,
and what reaches the driver is at most that many rows of kept features. Scoring covers all
documents in one pass without a shuffle.

Defined cases: a null or empty text has no features and gets the probability of such a text;
a null label is no label; an id with several labels or rows enters once; without labels of
both kinds a category has a constant probability (0 if there are none), so nothing is
rejected; an empty table gives an empty result. Further columns are kept and not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.shared import workspace, written

MAX_LABELLED = 20_000
MAX_FEATURES = 1_000
LEAST_DOCUMENTS = 3
FOLDS = 5
PREFIXES = range(3, 7)
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: The chain: categories of toxic text by how it is written, then toxicity as such.
CATEGORIES = (
    ("toxic_junk", "toxic = 1 AND quality = 0"),
    ("toxic_prose", "toxic = 1 AND coalesce(quality, 1) = 1"),
    ("toxic", "toxic = 1"),
)
#: Entries of a worker's cache of words, and of the counts that it holds before it hands them on.
HELD = 200_000


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def text_features(text: str | None) -> set[str]:
    return {f for word in set(WORD.findall((text or "").lower())) for f in word_features(word)}


#: Numbers of the kept features of a text, and its measures.
Hit = tuple[list[int], list[float]]
MEASURES = 3

# ---- linear models -----------------------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Rows:
    """Binary features as (row, feature) pairs and a few dense columns."""

    row: np.ndarray
    feature: np.ndarray
    dense: np.ndarray
    width: int

    def subset(self, keep: np.ndarray) -> "Rows":
        number = np.cumsum(keep) - 1
        inside = keep[self.row]
        return Rows(number[self.row[inside]], self.feature[inside], self.dense[keep], self.width)

    def times(self, weights: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, weights[self.feature], len(self.dense))
        return sparse + self.dense @ weights[self.width : -1] + weights[-1]

    def transposed(self, values: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.feature, values[self.row], self.width)
        return np.concatenate([sparse, self.dense.T @ values, [values.sum()]])


def fit_logistic(rows: Rows, y: np.ndarray, l2: float = 1e-5, steps: int = 400) -> np.ndarray:
    """Weights, the last one being the intercept, by accelerated gradient descent."""
    size = rows.width + rows.dense.shape[1] + 1
    if y.size == 0 or y.min() == y.max():
        return np.append(np.zeros(size - 1), 35.0 if y.size and y[0] else -35.0)
    vector = np.ones(size)
    for _ in range(15):
        vector = rows.transposed(rows.times(vector)) / len(y)
        largest = np.linalg.norm(vector)
        vector /= largest
    rate = 1 / (0.3 * largest + l2)
    weights = moved = np.zeros(size)
    for step in range(steps):
        slope = rows.transposed(sigmoid(rows.times(moved)) - y) / len(y) + l2 * np.append(moved[:-1], 0)
        new = moved - rate * slope
        moved = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


def best_threshold(probability: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap below the cut that maximises F1, but no less than even odds; above 1 without positives."""
    if not y.any():
        return 1.1
    order = np.argsort(-probability, kind="stable")
    ranked, found = probability[order], np.cumsum(y[order])
    f1 = 2 * found / (np.arange(len(y)) + 1 + y.sum())
    f1[:-1][ranked[:-1] == ranked[1:]] = 0  # equal probabilities fall on the same side
    cut = int(f1.argmax())
    return max(0.5, float((ranked[cut] + (ranked[cut + 1] if cut + 1 < len(ranked) else 0)) / 2))


@dataclass
class Chain:
    """Fitted models in chain order."""

    names: list[str]
    features: dict[str, float]
    weights: list[np.ndarray]
    threshold: float

    def probabilities(self, hits: list[Hit]) -> np.ndarray:
        """A row per text and a column per category."""
        row, feature, dense = _columns(hits)
        for weights in self.weights:
            rows = Rows(row, feature, dense, len(self.features))
            dense = np.column_stack([dense, sigmoid(rows.times(weights))])
        return dense[:, MEASURES:]


def _columns(hits: list[Hit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(hits)), [len(features) for features, _ in hits])
    feature = np.array([f for features, _ in hits for f in features], np.int64)
    return row, feature, np.array([measures for _, measures in hits], float).reshape(-1, MEASURES)


def fit_chain(
    hits: list[Hit], labels: np.ndarray, folds: np.ndarray, features: dict[str, float], names: list[str]
) -> Chain:
    """``labels`` has a column per category; ``folds`` the fold of each row."""
    row, feature, dense = _columns(hits)
    weights, held_out = [], np.zeros(len(hits))
    for y in labels.T.astype(float):
        rows, held_out = Rows(row, feature, dense, len(features)), np.zeros(len(hits))
        for fold in range(FOLDS):
            inside = folds == fold
            if inside.any():
                held_out[inside] = sigmoid(rows.subset(inside).times(fit_logistic(rows.subset(~inside), y[~inside])))
        weights.append(fit_logistic(rows, y))
        dense = np.column_stack([dense, held_out])
    threshold = best_threshold(held_out, labels[:, -1])
    return Chain(names, features, weights, threshold)


# ---- Spark -------------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, categories, max_labelled: int) -> DataFrame:
    """``key, text, fold`` and a 0/1 column per category, at most ``max_labelled`` ids."""
    known = labels.select(F.col(key).alias("key"), *[F.expr(f"cast({c} AS int)").alias(f"c{i}") for i, (_, c) in
                                                      enumerate(categories)])
    known = known.dropna().groupBy("key").agg(*[F.max(f"c{i}").alias(f"c{i}") for i in range(len(categories))])
    chosen = known.orderBy(F.xxhash64("key"), "key").limit(max_labelled)  # bounded, hence the broadcast
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen), "key").dropDuplicates(["key"])
    return joined.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(FOLDS)).cast("int"))


def select_features(sample: DataFrame, label: str, max_features: int) -> dict[str, float]:
    """The features that speak most for a toxic text, beyond what chance would give.

    A feature is kept if its log-likelihood ratio is above that of the luckiest of as many
    meaningless ones; the order is by share of toxic documents times log ratio of the shares.
    Its value is the lower limit of its log odds, 0 at least.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["label"]):
                for feature in text_features(text if isinstance(text, str) else None):
                    seen.setdefault(feature, [0, 0])[int(toxic)] += 1
                if len(seen) > HELD:
                    yield table(seen)
                    seen = {}
        yield table(seen)

    def table(seen: dict[str, list[int]]) -> pd.DataFrame:
        return pd.DataFrame({"feature": list(seen), "bad": [n[1] for n in seen.values()], "fine": [n[0] for n in seen.values()]})

    totals = sample.agg(F.sum(label), F.count(F.lit(1))).first()
    bad, fine = totals[0] or 0, totals[1] - (totals[0] or 0)
    if not bad or not fine:
        return {}
    counts = sample.select("text", F.col(label).alias("label")).mapInPandas(counted, "feature string, bad long, fine long")
    totalled = counts.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    rate, seen = bad / (bad + fine), F.col("bad") + F.col("fine")

    def surprise(count: Column, expected: Column) -> Column:
        return F.when(count > 0, 2 * count * F.log(count / expected)).otherwise(0.0)

    ratio = surprise(F.col("bad"), seen * rate) + surprise(F.col("fine"), seen * (1 - rate))
    likely = totalled.filter((F.col("bad") >= LEAST_DOCUMENTS) & (F.col("bad") > seen * rate)).withColumn("ratio", ratio)
    # The largest ratio among m features without meaning is about 2 ln m if they are frequent, and less if not.
    tested = totalled.agg((1.4 * F.log(F.count(F.lit(1)) + 1)).alias("noise")).first()["noise"]
    share = F.col("bad") / F.lit(bad)
    score = share * F.log(share / ((F.col("fine") + F.lit(0.5)) / F.lit(fine)))
    found = likely.filter(F.col("ratio") > tested).withColumn("score", score)
    best = found.orderBy(F.desc("score"), "feature").limit(max_features).collect()

    def strength(n: int, other: int) -> float:
        odds = np.log((n + 0.5) / (other + 0.5)) - np.log(bad / fine)
        return float(max(0.0, odds - 1.64 * np.sqrt(1 / (n + 0.5) + 1 / (other + 0.5))))

    return {r["feature"]: strength(r["bad"], r["fine"]) for r in best}


class Hits:
    """Kept features and measures of texts, with a bounded cache by word."""

    def __init__(self, features: dict[str, float]) -> None:
        self.number, self.strength = {f: i for i, f in enumerate(features)}, list(features.values())
        self.by_word: dict[str, tuple[tuple[int, ...], float]] = {}

    def of_word(self, word: str) -> tuple[tuple[int, ...], float]:
        if len(self.by_word) > HELD:
            self.by_word.clear()
        hits = tuple(self.number[f] for f in word_features(word) if f in self.number)
        found = self.by_word[word] = (hits, max((self.strength[i] for i in hits), default=0.0))
        return found

    def of_text(self, text: str | None) -> Hit:
        known, found, strongest, distinct, every, n_words = self.by_word, set(), 0.0, 0.0, 0.0, 0
        for word, count in Counter(WORD.findall(text.lower())).items() if text else ():
            n_words += count
            hits, strength = known.get(word) or self.of_word(word)
            if hits:
                found.update(hits)
                strongest = max(strongest, strength)
                distinct += strength
                every += strength * count
        return sorted(found), [strongest, float(np.log1p(distinct)), float(np.log1p(every * 100 / (n_words + 20)))]


def train_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", categories=CATEGORIES,
    max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES,
) -> Chain:
    with workspace(docs.sparkSession):
        sample = written(labelled_sample(docs, labels, key, text, categories, max_labelled), "labelled")
        return _train(sample, categories, max_features)


def _train(sample: DataFrame, categories, max_features: int) -> Chain:
    columns = [f"c{i}" for i in range(len(categories))]
    features = select_features(sample, columns[-1], max_features)

    @F.pandas_udf("features array<int>, measures array<double>")
    def hits_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hits = Hits(features)
        for texts in batches:
            found = [hits.of_text(t if isinstance(t, str) else None) for t in texts]
            yield pd.DataFrame(found, columns=["features", "measures"])

    rows = sample.select(hits_of("text").alias("hits"), "fold", *columns).collect()
    table = np.array([[r[c] for c in columns] for r in rows], np.int64).reshape(-1, len(columns))
    folds = np.array([r["fold"] for r in rows], np.int64)
    return fit_chain([(r["hits"]["features"], r["hits"]["measures"]) for r in rows], table, folds, features, [name for name, _ in categories])


def toxicity_of(docs: DataFrame, chain: Chain, text: Column) -> Column:
    """A struct of one probability per category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf(", ".join(f"{name} double" for name in chain.names))
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        chain = shared.value
        hits = Hits(chain.features)
        for texts in batches:
            found = [hits.of_text(t if isinstance(t, str) else None) for t in texts]
            yield pd.DataFrame(chain.probabilities(found), columns=chain.names)

    return scored(text.cast("string"))


def judge_toxicity(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, a probability per category and ``rejected`` of every row."""
    scored = docs.select(key, toxicity_of(docs, chain, F.col(text)).alias("__p"))
    return scored.select(
        key, *[F.col(f"__p.{name}").alias(f"p_{name}") for name in chain.names],
        (F.col(f"__p.{chain.names[-1]}") >= chain.threshold).alias("rejected"),
    )


def drop_toxic(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    scored = docs.withColumn("__toxicity", toxicity_of(docs, chain, F.col(text))[chain.names[-1]])
    return scored.filter(F.col("__toxicity") < chain.threshold).drop("__toxicity")
