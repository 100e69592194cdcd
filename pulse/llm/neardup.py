"""Near-duplicate documents by improved consistent weighted sampling.

A text is a multiset of 5-word shingles, each weighted by TF-IDF. The inverse document frequency
is smoothed: from 1 for a shingle of one document down to ``IDF_FLOOR`` for one that all
have, so that texts do not lose similarity because many others are similar to them too.
Frequencies come from a sketch that counts every shingle of every document.

Signatures are improved consistent weighted samples: per hash function each shingle draws from
(hash, weight) and the smallest draw is the sample; two texts agree with the probability of
their weighted Jaccard similarity. Bands of ``ROWS`` samples make candidates, and each candidate
pair is verified by the exact weighted Jaccard similarity of the whole texts.

Equal texts are one node from the start. Nodes of a band are not paired with each other: each
is verified against the band's hub, the node with most company in all its bands, which is where
the text that others derive from stands out. Nodes without a link go on in stricter
bands of ``STRICT_ROWS`` samples that texts of middling similarity rarely share: there one of
them for each band, and then each that is left, is verified against all others of its bands. At
last every pair of a band whose nodes lie in different components by then is verified, so no
link between two nodes of a band is missing where it would join classes. Three exact bounds rule
pairs out before: the distance ``1 - similarity`` is a metric, so distances to a common
hub may not differ too much; shingles that one node alone has are shared with no other; and each
bit that differs between two texts' parity marks, one bit flipped by each shingle of a text, stands for
a shingle that one of them has more often. They are part of the joins' conditions, so the pairs of
a large group of texts just below the threshold are neither moved nor verified.
Verified pairs are links; classes are their connected components, found by label propagation on
tables in the shared folder.

Defined cases: a null text is an empty one; texts without words are near-duplicates of equal
texts only; a class is named by its smallest key (null only if all are); rows with equal
key and text each appear; empty tables give empty results; only key and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.membership import maybe_member, members
from pulse.llm.shared import workspace, written
from pulse.llm.shingles import Sketch, chunks, distinct, mix, shingles, sketch_of, text_buffer

THRESHOLD = 0.8
BANDS, ROWS = 12, 4
STRICT_BANDS, STRICT_ROWS = 32, 10
IDF_FLOOR = 0.9
#: Words of 64 parity bits of a text; texts of many more shingles than bits are told apart by verification alone.
MARK_WORDS = 32

_TABLE_BITS = 16
_random = np.random.default_rng(19970402)
_SIZE = 1 << _TABLE_BITS
# Draws of the sampling scheme by a hash: r and c from Gamma(2, 1), beta uniform.
_R = _random.gamma(2.0, 1.0, _SIZE).astype(np.float32)
_LOG_C = np.log(_random.gamma(2.0, 1.0, _SIZE)).astype(np.float32)
_BETA = _random.random(_SIZE).astype(np.float32)
_FUNCTION = _random.integers(1, 1 << 63, max(BANDS * ROWS, STRICT_BANDS * STRICT_ROWS), np.uint64) | np.uint64(1)


# ---- weights and signatures --------------------------------------------------------------------


def weights(hashes: np.ndarray, tf: np.ndarray, sketch: Sketch, documents: int) -> np.ndarray:
    """TF-IDF with the smoothed inverse document frequency."""
    common = np.minimum(np.log(sketch.counts(hashes)) / math.log(max(documents, 2)), 1.0)
    return (tf * (1.0 - (1.0 - IDF_FLOOR) * common)).astype(np.float32)


def signatures(row: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n_functions: int) -> tuple[np.ndarray, np.ndarray]:
    """``(rows that have shingles, samples)``; input sorted by row and hash, one line per distinct shingle."""
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    counts = np.diff(np.append(starts, len(row)))
    log_weight = np.log(weight)
    samples = np.empty((len(starts), n_functions), np.uint64)
    number = np.repeat(np.arange(len(starts)), counts)
    for k in range(n_functions):
        at = ((hashes * _FUNCTION[k]) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        r, beta = _R[at], _BETA[at]
        level = np.floor(log_weight / r + beta)
        draw = _LOG_C[at] - r * (level - beta + 1)
        smallest = np.flatnonzero(draw == np.repeat(np.minimum.reduceat(draw, starts), counts))
        # Of equal draws the smaller hash counts, which comes first.
        owner = number[smallest]
        chosen = smallest[np.concatenate([[True], owner[1:] != owner[:-1]])]
        samples[:, k] = mix(hashes[chosen] ^ mix((level[chosen].astype(np.int64) + k * 4096).astype(np.uint64)))
    return row[starts], samples


def band_hashes(samples: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit number per band; those of different bands differ."""
    bands = samples.reshape(len(samples), -1, rows)
    total = np.zeros(bands.shape[:2], np.uint64)
    for k in range(rows):
        total = mix(total + bands[:, :, k])
    return mix(total + np.arange(bands.shape[1], dtype=np.uint64)).view(np.int64)


def weighted_shingles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of rows: ``first row, end, row, hash, tf`` of the distinct shingles."""
    data, offsets = text_buffer(column)
    for start, stop in chunks(offsets):
        row, value = shingles(data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start])
        yield start, stop, *distinct(row, value)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two ``(sorted hashes, weights)``."""
    total = a[1].sum(dtype=float) + b[1].sum(dtype=float)
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    shared = np.minimum(a[1][same], b[1][at[same]]).sum(dtype=float) if same.any() else 0.0
    return shared / (total - shared) if total else 0.0


def parity_marks(row: np.ndarray, hashes: np.ndarray, tf: np.ndarray, rows: int) -> np.ndarray:
    """``MARK_WORDS`` numbers for each row: every occurrence of a shingle flips one bit."""
    before = np.repeat(np.cumsum(tf) - tf, tf)
    flips = mix(np.repeat(hashes, tf) + mix((np.arange(len(before)) - before).astype(np.uint64)))
    bits = np.repeat(row, tf) * (MARK_WORDS * 64) + (flips % np.uint64(MARK_WORDS * 64)).astype(np.int64)
    places, times = np.unique(bits, return_counts=True)
    odd = places[times % 2 == 1]
    marks = np.zeros(rows * MARK_WORDS, np.uint64)
    np.bitwise_or.at(marks, odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
    return marks.view(np.int64).reshape(rows, MARK_WORDS)


# ---- candidates and links ----------------------------------------------------------------------


def _node(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("node")


def band_table(texts: DataFrame, sketch: Sketch, documents: int, bands: int, rows: int) -> DataFrame:
    """``band, node`` of ``node, text``; a band's hash says which band it is."""
    shared = texts.sparkSession.sparkContext.broadcast((sketch.cells, documents))

    def sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, documents = shared.value
        sketch = Sketch(cells)
        for batch in batches:
            for start, _, row, value, tf in weighted_shingles(batch.column(1)):
                if not len(row):
                    continue
                own, samples = signatures(row, value, weights(value, tf, sketch, documents), bands * rows)
                nodes = batch.column(0).take(pa.array(np.repeat(own + start, bands)))
                yield pa.RecordBatch.from_arrays([pa.array(band_hashes(samples, rows).ravel()), nodes], ["band", "node"])

    return texts.mapInArrow(sampled, "band long, node binary")


def shared_bands(bands: DataFrame) -> DataFrame:
    """The distinct rows of bands with several nodes."""
    number = F.xxhash64("node")
    several = bands.groupBy("band").agg(F.min(number).alias("low"), F.max(number).alias("high")).filter("low <> high")
    return bands.join(several.select("band"), "band").distinct()


def verify(pairs: DataFrame, texts: DataFrame, sketch: Sketch, documents: int) -> DataFrame:
    """``node, leader, similarity`` of every pair, from the whole texts."""
    shared = pairs.sparkSession.sparkContext.broadcast((sketch.cells, documents))

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, documents = shared.value
        sketch = Sketch(cells)

        def sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
            found = [None] * len(column)
            for start, stop, row, value, tf in weighted_shingles(column):
                weight, cuts = weights(value, tf, sketch, documents), np.searchsorted(row, np.arange(stop - start + 1))
                for i in range(stop - start):
                    found[start + i] = (value[cuts[i] : cuts[i + 1]], weight[cuts[i] : cuts[i + 1]])
            return found

        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
                # Many pairs of a batch have the same leader: its text is taken apart once.
                leaders, number = np.unique(np.array(part.column(1).to_pylist(), object), return_inverse=True)
                first = {n: i for i, n in reversed(list(enumerate(number.tolist())))}
                of_leader = sets(part.column(3).take(pa.array([first[n] for n in range(len(leaders))])))
                found = [weighted_jaccard(own, of_leader[n]) for own, n in zip(sets(part.column(2)), number.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.float64())],
                                                 ["node", "leader", "similarity"])

    leaders = texts.select(F.col("node").alias("leader"), F.col("text").alias("leader_text"))
    joined = pairs.join(texts, "node").join(leaders, "leader")
    return joined.select("node", "leader", "text", "leader_text").mapInArrow(
        compared, "node binary, leader binary, similarity double"
    )


def texts_of(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """``node, text`` of the listed nodes, one row for all documents with the same text."""
    rows = docs.select(F.col(key).alias("key"), _node(text), F.col(text).cast("string").alias("text"))
    listed = maybe_member(members(nodes.select(F.xxhash64("node"))), F.xxhash64("node"), docs)
    firsts = rows.groupBy("node").agg(F.min("key").alias("w_key")).join(nodes, "node").withColumnRenamed("node", "w_node")
    same = (F.col("node") == F.col("w_node")) & F.col("key").eqNullSafe(F.col("w_key"))
    texts = written(rows.filter(listed).join(firsts, same, "left_semi").select("node", "text"), "texts")
    repeated = texts.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    return texts.dropDuplicates(["node"]) if repeated else texts


def links(docs: DataFrame, key: str, text: str, sketch: Sketch, documents: int, threshold: float) -> DataFrame | None:
    """Verified ``node, leader`` pairs."""
    rows = docs.select(_node(text), F.col(text).cast("string").alias("text"))
    bands = written(shared_bands(written(band_table(rows, sketch, documents, BANDS, ROWS), "bands")), "shared")
    if not bands.take(1):
        return None
    texts = texts_of(docs, bands.select("node").distinct(), key, text)

    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    company = bands.join(sizes, "band").groupBy("node").agg(F.sum("n").alias("company"))
    hubs = bands.join(company, "node").groupBy("band").agg(
        F.max_by("node", F.struct("company", "node")).alias("leader"))
    pairs = bands.join(hubs, "band").filter("node <> leader").select("node", "leader").distinct()
    checked = written(verify(pairs, texts, sketch, documents), "checked")
    found = checked.filter(F.col("similarity") >= threshold).select("node", "leader")
    linked = found.select("node").union(found.select("leader")).distinct()
    opened = written(_several_labels(bands, found), "opened")
    if not opened.take(1):
        return found
    # What is open by now is the most that the later steps look at: links only join labels.
    bounds = written(_bounds(checked, texts.join(opened.select("node").distinct(), "node", "left_semi"), sketch, documents), "bounds")
    able = bounds.filter(F.col("common") >= F.col("total") * (threshold - 1e-6)).select("node")
    alone = written(able.join(linked, "node", "left_anti"), "alone")
    if alone.take(1):
        near = bands.join(bands.join(alone, "node", "left_semi").select("band").distinct(), "band", "left_semi")
        nodes = near.select("node").distinct().join(able, "node", "left_semi")
        strict = band_table(texts.join(nodes, "node", "left_semi"), sketch, documents, STRICT_BANDS, STRICT_ROWS)
        tried = _strict_pairs(strict, alone, bounds, texts, sketch, documents, threshold)
        found = found.unionByName(tried.filter(F.col("similarity") >= threshold).select("node", "leader"))
        checked = checked.unionByName(tried)
    opened = opened.select("band", "node").join(able, "node", "left_semi")
    last = verify(_pairs_between(_several_labels(opened, found), bounds, checked, threshold), texts, sketch, documents)
    return found.unionByName(written(last, "checked").filter(F.col("similarity") >= threshold).select("node", "leader")).distinct()


def _several_labels(bands: DataFrame, found: DataFrame) -> DataFrame:
    """``band, node, label, side`` of bands whose nodes lie in several components; ``side`` is false in a band's largest one."""
    labelled = written(bands.join(components(found), "node", "left").select(
        "band", "node", F.coalesce("label", "node").alias("label")), "labelled")
    counts = labelled.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    several = counts.groupBy("band").agg(F.max_by("label", F.struct("n", "label")).alias("most"),
                                         F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    return labelled.join(several, "band").select("band", "node", "label", (F.col("label") != F.col("most")).alias("side"))


def _bounds(checked: DataFrame, texts: DataFrame, sketch: Sketch, documents: int) -> DataFrame:
    """``node, hub, to_hub, total, common, marks`` of the texts: the most similar hub, all weight, that of shingles not its own, parity."""
    shared = texts.sparkSession.sparkContext.broadcast((sketch.cells, documents))
    columns = ["node", "high", "low", "hash", "weight", "marks"]
    kind = pa.list_(pa.int64())

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each shingle, and one with the node for the whole text."""
        cells, documents = shared.value
        sketch = Sketch(cells)
        for batch in batches:
            halves = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 2)
            for start, stop, row, value, tf in weighted_shingles(batch.column(1)):
                weight = weights(value, tf, sketch, documents).astype(float)
                total = np.bincount(row, weight, stop - start)
                ends = pa.array(np.arange(0, (stop - start + 1) * MARK_WORDS, MARK_WORDS, dtype=np.int32))
                marks = pa.ListArray.from_arrays(ends, pa.array(parity_marks(row, value, tf, stop - start).ravel()))
                for nodes, half, hashes, own, mark in (
                    (pa.nulls(len(row), pa.binary()), halves[row + start], pa.array(value.view(np.int64)), weight, pa.nulls(len(row), kind)),
                    (batch.column(0).slice(start, stop - start), halves[start:stop], pa.nulls(stop - start, pa.int64()), total, marks),
                ):
                    yield pa.RecordBatch.from_arrays(
                        [nodes, *(pa.array(np.ascontiguousarray(half[:, i])) for i in range(2)), hashes, pa.array(own), mark], columns)

    both = written(texts.select("node", "text").mapInArrow(
        weighed, "node binary, high long, low long, hash long, weight double, marks array<long>"), "weights")
    # A shingle that is counted once has the one row whose values are the smallest.
    once = both.filter("hash IS NOT NULL").groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in ("high", "low", "weight"))).filter("n = 1")
    own = once.groupBy("high", "low").agg(F.sum("weight").alias("own"))
    totals = both.filter("node IS NOT NULL").select("node", "high", "low", F.col("weight").alias("total"), "marks")
    common = totals.join(own, ["high", "low"], "left").select(
        "node", "total", (F.col("total") - F.coalesce("own", F.lit(0.0))).alias("common"), "marks")
    main = checked.groupBy("node").agg(F.max_by("leader", "similarity").alias("hub"), F.max("similarity").alias("to_hub"))
    self_ = checked.select(F.col("leader").alias("node"), F.col("leader").alias("hub"), F.lit(1.0).alias("to_hub")).distinct()
    return common.join(main.unionByName(self_.join(main, "node", "left_anti")), "node", "left")


def _possible(threshold: float) -> Column:
    """Whether the bounds of ``a`` and ``b`` leave the similarity open."""
    same_hub = F.coalesce(F.col("a.hub") == F.col("b.hub"), F.lit(False))
    apart = same_hub & (F.abs(F.col("a.to_hub") - F.col("b.to_hub")) > 1 - threshold + 1e-6)
    total = F.col("a.total") + F.col("b.total")
    most = F.least("a.common", "b.common") * (1 + threshold) >= total * (threshold - 1e-6)
    # An occurrence weighs IDF_FLOOR at least; similar texts differ in (1 - threshold) / (1 + threshold) of their weight at most.
    differing = reduce(add, (F.bit_count(F.col("a.marks")[i].bitwiseXOR(F.col("b.marks")[i])) for i in range(MARK_WORDS)))
    return ~apart & most & (differing * (IDF_FLOOR * (1 + threshold)) <= total * (1 - threshold + 1e-6))


def _unordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("node"), F.greatest(a, b).alias("leader")]


def _strict_pairs(strict, alone, bounds, texts, sketch: Sketch, documents: int, threshold: float) -> DataFrame:
    """Verified pairs, with similarity, of the nodes ``alone`` in their strict bands."""
    bands = shared_bands(written(strict, "bands")).join(bounds, "node")
    open_ = written(bands.join(alone.withColumn("alone", F.lit(True)), "node", "left").fillna(False, ["alone"]), "strict")

    def tried(one: DataFrame, others: DataFrame) -> DataFrame:
        met = one.alias("a").join(others.alias("b"), F.col("a.band") == F.col("b.band"))
        pairs = met.filter((F.col("a.node") != F.col("b.node")) & _possible(threshold)).select(
            *_unordered("a.node", "b.node")).distinct()
        return written(verify(pairs, texts, sketch, documents), "tried")

    # One node of each band first: a group of similar ones is then linked. The others meet all of their band.
    chosen = open_.filter("alone").groupBy("band").agg(F.min("node").alias("node"))
    first = tried(open_.join(chosen, ["band", "node"], "left_semi"), open_)
    similar = first.filter(F.col("similarity") >= threshold)
    linked = similar.select("node").union(similar.select("leader")).distinct()
    rest = open_.filter("alone").join(linked, "node", "left_anti").join(chosen, ["band", "node"], "left_anti")
    return first.unionByName(tried(rest, open_))


def _pairs_between(opened: DataFrame, bounds: DataFrame, checked: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a band's nodes in different components that are not verified yet and that the bounds leave open."""
    rows = written(opened.join(bounds, "node"), "between")
    met = rows.filter("side").alias("a").join(rows.alias("b"), F.col("a.band") == F.col("b.band"))
    pairs = met.filter((F.col("a.label") != F.col("b.label")) & _possible(threshold)).select(
        *_unordered("a.node", "b.node")).distinct()
    return pairs.join(checked.select(*_unordered("node", "leader")), ["node", "leader"], "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node in an edge, the label being the component's smallest node.

    Each round a node takes the smallest label around it and then that label's own label,
    so long chains shrink by half at least.
    """
    both = written(edges.select(F.col("node").alias("a"), F.col("leader").alias("b")).unionByName(
        edges.select(F.col("leader").alias("a"), F.col("node").alias("b"))), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = written(lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if not moved.filter("label <> old").take(1):
            return labels


def _classes(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """``node, label, class_id`` of every text; ``label`` tells classes apart whose smallest keys are equal."""
    def of_batch(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, _, value, _ in weighted_shingles(batch.column(0)):
            yield value

    with workspace(docs.sparkSession):
        documents = docs.count()
        sketch = sketch_of(docs.select(F.col(text).cast("string")), of_batch)
        edges = links(docs, key, text, sketch, documents, threshold)
        firsts = docs.select(key, _node(text)).groupBy("node").agg(F.min(key).alias("first"))
        if edges is None:
            classes = firsts.select("node", F.col("node").alias("label"), F.col("first").alias("class_id"))
        else:
            labelled = firsts.join(components(edges), "node", "left").withColumn("label", F.coalesce("label", "node"))
            smallest = labelled.groupBy("label").agg(F.min("first").alias("class_id"))
            classes = labelled.join(smallest, "label").select("node", "label", "class_id")
        return written(classes, "classes", keep=True)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``key, node, class_id`` of every row; ``class_id`` is the smallest key of the row's class."""
    return docs.select(key, _node(text)).join(_classes(docs, key, text, threshold), "node").select(key, "node", "class_id")


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of every class, with all its columns: the one with the smallest key, then the smallest node."""
    rows = docs.select(F.col(key).alias("__key"), _node(text).alias("__node"))
    classes = _classes(docs, key, text, threshold).withColumnRenamed("node", "__node")
    smallest = rows.join(classes, "__node").filter(F.col("__key").eqNullSafe(F.col("class_id"))).groupBy(
        "label", "__node", "__key").agg(F.count(F.lit(1)).alias("__rows"))
    first = F.min(F.struct("__node", "__key", "__rows")).alias("first")
    chosen = written(smallest.groupBy("label").agg(first).select("first.*"), "kept", keep=True)
    mine = docs.withColumn("__of", _node(text))
    same = (F.col("__of") == F.col("__node")) & F.col(key).eqNullSafe(F.col("__key"))
    once = mine.join(chosen.filter("__rows = 1"), same, "left_semi")
    # Rows that share key and text can only be told apart by dropping repeats.
    several = mine.join(chosen.filter("__rows > 1"), same, "left_semi").dropDuplicates([key, "__of"])
    return once.unionByName(several).drop("__of")
