"""The trie of conversation beginnings against one made of dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pulse.llm import queries as Q
from pulse.llm.prefixtrie import RESULT, Parentheses, conversation_turns, trie_nodes

SMALL = "/root/testdata/sf0.001"
ROWS = "conv_id bigint, turn bigint, role string, text string, at string, digest string, name string"


def brute_trie(paths):
    """Rows of all nodes from {conversation: ((role, text), ...)}."""
    members, rows = defaultdict(list), {}
    for conv, turns in paths.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        own = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for up in range(len(node) + 1):
            leaves[node[:up]] += node not in kids
            saved[node[:up]] += own
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows[node] = (min(convs), len(node), parent, len(convs), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
    return sorted(rows.values(), key=str)


def ordered(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: tuple((r, t) for _, _, r, t in sorted(turns)) for conv, turns in talks.items()}


def rebuilt(rows):
    talks = ordered(rows)
    found = {}
    for conv, turns in talks.items():
        taken = zlib.crc32(str(conv).encode()) % 6
        base = talks.get(conv - (abs(conv) % 100) * (1 if conv >= 0 else -1), ())
        found[conv] = base[:taken] + turns[taken:]
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROWS)


def nodes(found):
    return sorted((tuple(r[c] for c in RESULT) for r in found.collect()), key=str)


def family(seed, n, alphabet, depth):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randrange(1, depth)):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(alphabet) * rng.choice((1, 1, 3))))
    return rows


@pytest.mark.parametrize("shard_turns, shard_paths", [(200, 8), (2000, 16), (1 << 18, 16)])
def test_shards_of_any_size_give_the_same_trie(spark, shard_turns, shard_paths):
    rows = family(3, 150, ["a", "bc", "ü"], 7)
    rows += [(1000 + i, 0, "user", "hot") for i in range(600)]  # one node with ids of several pieces, in many shards
    rows += [(2000 + i, t, "user", "hot") for i in range(5) for t in range(30 * (i + 1))]  # chains
    found = trie_nodes(conversation_turns(frame(spark, rows)), shard_turns, shard_paths)
    assert nodes(found) == brute_trie(ordered(rows))


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (1, None, "user", "b"), (1, None, "user", "a"), (1, 0, None, None), (1, 0, None, None), (2, None, "user", "a"),
        (3, 1, "user", "x" * 2_000_000), (4, 1, "user", "x" * 2_000_000), (4, 2, "u", "ser"), (5, 1, "us", "er"),
        (6, 7, "user", ""), (-7, 7, "user", "ü"), (None, 1, "user", "nobody's"),
    ]
    found = trie_nodes(conversation_turns(frame(spark, rows)))
    assert nodes(found) == brute_trie(ordered(rows))


def test_one_conversation_and_none(spark):
    assert nodes(trie_nodes(conversation_turns(frame(spark, [(9, 0, "user", "hi")])))) == brute_trie({9: (("user", "hi"),)})
    assert trie_nodes(conversation_turns(frame(spark, []))).count() == 0


def test_rebuilt_conversations(spark):
    rows = [r for r in family(5, 260, ["a", "b"], 9) if r[0] not in (100, 7)]  # one group lacks its first conversation
    rows += [(-150, t, "user", "n") for t in range(4)] + [(-100, t, "user", "m") for t in range(6)]
    found = trie_nodes(Q.rebuilt_turns(conversation_turns(frame(spark, rows))), 50, 4)
    assert nodes(found) == brute_trie(rebuilt(rows))
    assert any(not turns for turns in rebuilt(rows).values())


def test_the_query_on_the_test_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = Q.op13_prefix_trie(spark, SMALL)
    assert all(kind == "bigint" for name, kind in found.dtypes if name != "ends_sha256")
    assert nodes(found) == brute_trie(rebuilt([tuple(r) for r in table.collect()]))


@pytest.mark.parametrize("block", [1, 4, 64])
@pytest.mark.parametrize("seed", range(4))
def test_findclose_and_leaf_pairs(seed, block):
    rng, signs, depth = random.Random(seed), [1], 1
    while depth:
        step = 1 if len(signs) < 400 and rng.random() < 0.55 else -1
        signs.append(step)
        depth += step
    partner, stack = {}, []
    for at, sign in enumerate(signs):
        if sign == 1:
            stack.append(at)
        else:
            partner[stack.pop()] = at
    made = Parentheses(np.array(signs), block)
    opened = np.flatnonzero(made.signs == 1)
    assert made.findclose(opened).tolist() == [partner[int(at)] for at in opened]
    assert np.flatnonzero(made.leaf_pairs()).tolist() == [at for at, close in sorted(partner.items()) if close == at + 1]
