"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tarn.llm import turns as turns_module
from tarn.llm.parentheses import Parentheses
from tarn.llm.prefix_trie import prefix_trie, rebuilt

SCHEMA = (
    "conv_id bigint, turn bigint, role string, text string, depth int, p1 string, "
    "TEXT string, n_convs double, last boolean, s1 bigint"
)


def frame(spark, rows):
    return spark.createDataFrame([(*row, 7, "x", "T", 0.5, True, 3) for row in rows], SCHEMA)


def conversations(rows):
    """Turns by conversation in order, as (role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0)
            found[conv].append((key, role or "", text or ""))
    for listed in found.values():
        listed.sort(key=lambda t: (t[0], _digest(t[1], t[2])))
    return {conv: [t[1:] for t in listed] for conv, listed in found.items()}


def _digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(convs):
    members = defaultdict(list)
    for conv, listed in convs.items():
        for d in range(len(listed) + 1):
            members[tuple(listed[:d])].append(conv)
    children, out = defaultdict(list), []
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def sums(node):
        leaves = saved = 0
        stack = [node]
        while stack:
            n = stack.pop()
            leaves += not children[n]
            saved += (len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0)
            stack.extend(children[n])
        return leaves, saved

    for node, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        leaves, saved = sums(node)
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            len(children[node]), leaves, saved,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(seed, convs=60, most=9, texts=2):
    pick = random.Random(seed)
    rows = []
    for conv in range(-3, convs):
        for turn in range(pick.randrange(most)):
            rows.append((conv, turn, pick.choice("ua"), "é" * pick.randrange(texts) + "t"))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [1, 3, 10, 4096])
def test_trie_against_brute_force(spark, shard):
    rows = random_rows(shard)
    # Many copies, one of them longer, and a caterpillar of prefixes.
    rows += [(100 + c, t, "u", f"same{t}") for c in range(12) for t in range(5)]
    rows += [(200 + c, t, "u", f"long{t}") for c in range(15) for t in range(c + 1)]
    got = prefix_trie(frame(spark, rows), shard=shard)
    assert got.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ]
    assert rows_of(got) == brute(conversations(rows))


def test_a_conversation_over_many_partitions(spark):
    """One conversation holds most turns; two more share its first half."""
    turns = [(5, t, "u", f"t{t % 7}") for t in range(700)]
    turns += [(6, t, "u", f"t{t % 7}") for t in range(350)]
    turns += [(7, t, "u", f"t{t % 7}") for t in range(350)] + [(7, 350, "u", "other")]
    rows = turns + [(c, 0, "a", "x") for c in range(5)]
    df = frame(spark, rows)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, False)
    try:
        states = turns_module.prefixes(df)
        tree = rows_of(prefix_trie(df, shard=2))
    finally:
        spark.conf.unset(name)
    assert states.where("conv_id = 5").select("part").distinct().count() > 1
    last = states.where("last").select("conv_id", "depth").collect()
    assert sorted(map(tuple, last)) == [(c, 1) for c in range(5)] + [(5, 700), (6, 350), (7, 351)]
    assert tree == brute(conversations(rows))


def test_states_of_parts_combine():
    pick = random.Random(1)
    digests = [pick.randbytes(16) for _ in range(20)]

    def state(part):
        p1 = p2 = 0
        for digest in part:
            p1, p2 = turns_module._advance(p1, p2, digest)
        return turns_module.State(1, len(part), p1, p2, 3 * len(part))

    for cut in range(21):
        assert state(digests[:cut]).then(state(digests[cut:])) == state(digests)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "", ""), (1, 1, "u", "x" * 200_000), (1, 1, "u", "b"),
        (2, None, "", ""), (2, None, None, None), (None, 0, "u", "lost"), (None, None, None, None),
        (3, 5, "u", "b"), (3, 5, "u", "b"), (-4, 9, "u", "b"), (9, 0, "user", "a"), (10, 0, "use", "ra"),
    ]
    assert rows_of(prefix_trie(frame(spark, rows))) == brute(conversations(rows))
    assert prefix_trie(frame(spark, [])).collect() == []


def test_conversations_without_turns_are_of_the_root(spark):
    rows = [(1, 0, "u", "a")]
    ids = spark.createDataFrame([(1,), (8,), (30,), (None,)], "conv_id bigint")
    want = brute({1: [("u", "a")], 8: [], 30: []})
    assert rows_of(prefix_trie(frame(spark, rows), ids)) == want
    none = prefix_trie(frame(spark, []), ids)
    assert rows_of(none) == brute({1: [], 8: [], 30: []})


def test_the_rebuilt_conversations(spark):
    rows = [(c, t, "u", f"{c}.{t}") for c in range(1, 13) for t in range(c % 4 + 7)]
    turns, ids = rebuilt(frame(spark, rows))
    own = conversations(rows)
    want = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    got = conversations(tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect())
    assert got == {c: listed for c, listed in want.items() if listed}
    assert sorted(r.conv_id for r in ids.collect()) == sorted(own)
    assert rows_of(prefix_trie(turns, ids)) == brute(want)


@pytest.mark.parametrize("nodes", [0, 1, 2, 300, 3000])
def test_parentheses_against_brute_force(nodes):
    pick = random.Random(nodes)
    parents = [pick.randrange(-1, n) if pick.random() < 0.7 else n - 1 for n in range(nodes)]
    weights = np.array([pick.randrange(100) for _ in range(nodes)], np.int64)
    tree = Parentheses(parents)
    closes = tree.closes()
    under, leaves = weights.tolist(), [0] * nodes
    has_child = set(parents)
    for n in range(nodes - 1, -1, -1):
        leaves[n] += n not in has_child
        if parents[n] >= 0:
            under[parents[n]] += under[n]
            leaves[parents[n]] += leaves[n]
    if nodes:
        assert tree.sums(closes, weights).tolist() == under
        assert tree.leaves(closes).tolist() == leaves
    assert all(tree.opens[p] < tree.opens[n] < closes[n] < closes[p]
               for n, p in enumerate(parents) if p >= 0)
