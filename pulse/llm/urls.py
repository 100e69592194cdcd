"""URL filter lists as a trie over reversed host labels and path segments.

A rule is a host, a path prefix and a verdict. It fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's path. Of several rules that fit, the
one with most host labels wins, then the one with the longest path, then block over allow.

The trie is a nested dict: one level for each host label from the right, then one for each
complete path segment; what follows the last slash of a rule's path is a prefix of the next
segment and is compared at the node. It goes to the executors as a broadcast while its
pickled size is below ``BROADCAST_BYTES``; larger lists are joined by host suffix instead.

Defined cases: a URL that is null or has no ``://`` has an empty host and path; no rule
fits an empty host; a URL without a fitting rule has a null rule and the default verdict;
of equal rules with different verdicts block counts; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
RESULT = "rule string, verdict string"

Rule = tuple[str, str, str]  # verdict, host, path


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def build_trie(rules: Iterable[Rule]) -> dict:
    """Node: ``{"hosts": {label: node}, "paths": {segment: node}, "rules": [(rest, verdict, text)]}``."""
    root: dict = {}
    for verdict, host, path in rules:
        if verdict not in (ALLOW, BLOCK) or not host or not path.startswith("/"):
            raise ValueError(f"not a rule: {verdict!r} {host!r} {path!r}")
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault("hosts", {}).setdefault(label, {})
        *segments, rest = path.split("/")
        for segment in segments:
            node = node.setdefault("paths", {}).setdefault(segment, {})
        node.setdefault("rules", []).append((rest, verdict, host + path))
    return root


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits."""
    found, node = None, trie
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get("hosts", {}).get(label)
        if node is None:
            break
        found = _match_path(node, segments) or found  # more host labels go before a longer path
    return found


def _match_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for depth, segment in enumerate(segments):
        fits = [(len(rest), verdict == BLOCK, rule, verdict)
                for rest, verdict, rule in node.get("rules", ()) if segment.startswith(rest)]
        if fits:
            best = max(fits)[2:]
        if depth == len(segments) - 1:
            break
        node = node.get("paths", {}).get(segment)
        if node is None:
            break
    return best


def judge_urls(
    pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = ALLOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``key, host, path, rule, verdict`` of every row."""
    parts = pages.select(key, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    trie = build_trie(rules)
    if len(pickle.dumps(trie)) > broadcast_bytes:
        return _judge_by_join(parts, rules, key, default)
    shared = pages.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for hosts, paths in batches:
            found = [match(trie, host, path) or (None, default) for host, path in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    found = parts.withColumn("__found", judged("host", "path"))
    return found.select(key, "host", "path", F.col("__found.rule").alias("rule"), F.col("__found.verdict").alias("verdict"))


def _judge_by_join(parts: DataFrame, rules: list[Rule], key: str, default: str) -> DataFrame:
    """For lists too large to broadcast: each distinct host meets the rules of its suffixes in a join."""
    spark = parts.sparkSession
    listed = spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")
    places = parts.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    starts = F.sequence(F.lit(1), F.size(labels))
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = places.select("host", "path", F.explode(suffixes).alias("rule_host"))
    fits = probes.join(listed, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    order = F.struct(F.size(F.split("rule_host", "\\.")), F.length("rule_path"), F.col("verdict") == BLOCK)
    best = fits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("__best")
    )
    joined = parts.join(best, ["host", "path"], "left")
    return joined.select(
        key, "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"),
    )
