"""Exact and SimHash deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash
from oddities import TEXTS, empty, frame, odd, sentence

from tarn.llm import simhash
from tarn.llm.components import connected_components
from tarn.llm.exact_dedup import drop_exact_copies, exact_groups
from tarn.llm.queries import ORACLES, QUERIES
from tarn.llm.simhash import BKTree, drop_near_copies, fingerprint, simhash_groups


def documents(sf_dir):
    query = f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'"
    return duckdb.connect().execute(query).fetchall()


def test_exact_query_is_its_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = QUERIES["op8_exact_dedup"](spark, sf_dir)
    columns = "doc_id, keep_id, group_size, kept, text_sha256"
    expected = duck.execute(f"SELECT {columns} FROM ({ORACLES['op8_exact_dedup']})").fetchall()
    assert sorted(tuple(r) for r in got.select(*columns.split(", ")).collect()) == sorted(expected)


def test_exact_groups_of_odd_rows(spark):
    members = defaultdict(list)
    for doc_id, text in TEXTS:
        members[text or ""].append(doc_id)
    expected = []
    for doc_id, text in TEXTS:
        ids = members[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        expected.append((doc_id, keep, len(ids), doc_id == keep))
    got = [tuple(r) for r in exact_groups(odd(spark)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert exact_groups(empty(spark)).collect() == []


def test_exact_copies_go_and_repeated_rows_leave_one(spark):
    left = drop_exact_copies(odd(spark))
    assert left.columns == odd(spark).columns
    rows = [(r[0], r[1]) for r in left.collect()]
    texts = [text or "" for _, text in rows]
    assert sorted(texts) == sorted({text or "" for _, text in TEXTS})
    best = {}
    for doc_id, text in TEXTS:
        if doc_id is not None:
            best[text or ""] = max(doc_id, best.get(text or "", doc_id))
    assert all(best[text or ""] == doc_id for doc_id, text in rows)
    assert drop_exact_copies(empty(spark)).collect() == []


def test_a_hot_text_among_equal_prefixes(spark):
    prefix = "p" * 300
    rows = [(i, prefix + ("same" if i % 3 == 0 else f"{i:06d}"[-4:])) for i in range(900)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_groups(frame(spark, rows)).collect()}
    assert got[0] == (897, 300, False) and got[897] == (897, 300, True)
    assert got[1] == (1, 1, True)
    assert drop_exact_copies(frame(spark, rows)).count() == 601


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """(doc_id, print) pairs to {doc_id: least id reachable}, comparing all distinct prints."""
    least = {}
    for doc_id, p in prints:
        least[p] = min(doc_id, least.get(p, doc_id))
    values = np.array(sorted(least), np.uint64)
    root = {p: p for p in least}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(values):
        near = np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ p) <= 2) + i + 1
        for q in values[near]:
            root[find(int(q))] = find(int(p))
    smallest = {}
    for p in least:
        smallest[find(p)] = min(least[p], smallest.get(find(p), least[p]))
    return {doc_id: smallest[find(p)] for doc_id, p in prints}


def test_fingerprint_is_the_plain_one():
    for _, text in TEXTS:
        if len(text or "") < 50_000:
            assert fingerprint((text or "").encode()) == plain_fingerprint(text or "")
    assert fingerprint("A B c".encode()) == plain_fingerprint("A B c")


def test_simhash_query_is_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op3_simhash_near_dedup"](spark, sf_dir).collect()}
    prints = [(d, plain_fingerprint(t)) for d, t in documents(sf_dir)]
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints}
    assert {d: r.component_id for d, r in got.items()} == plain_components(prints)


@pytest.mark.parametrize("most", [4, 2048])
def test_links_of_clustered_fingerprints(spark, monkeypatch, most):
    """Dense balls of fingerprints, whose shards are cut again when ``most`` is small."""
    monkeypatch.setattr(simhash, "MAX_TREE", most)
    random.seed(5)
    prints = []
    for centre in (random.getrandbits(64) for _ in range(6)):
        for _ in range(60):
            flips = random.sample(range(64), random.choice([0, 1, 1, 2, 3, 4, 6]))
            prints.append(centre ^ sum(1 << f for f in flips))
    prints = sorted(set(prints) | {random.getrandbits(64) for _ in range(100)})
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    reps = spark.createDataFrame(rows, "id bigint, print bigint")
    linked = {r.node: r.component for r in connected_components(simhash._links(reps)).collect()}
    expected = plain_components(list(enumerate(prints)))
    assert {i: linked.get(i, i) for i in expected} == expected


def test_tree_follows_edges_and_misses_nothing():
    random.seed(1)
    values = [random.getrandbits(12) for _ in range(400)]
    tree = BKTree()
    for value in dict.fromkeys(values):
        tree.add(value)
    for query in range(0, 4096, 37):
        found = sorted(tree.values[n] for n in tree.within(query, 2))
        assert found == sorted(v for v in set(values) if (v ^ query).bit_count() <= 2)


def test_a_shard_gives_fewer_links_than_members():
    prints = [1 << i for i in range(40)]
    links = simhash._shard_links(prints, list(range(40)))
    assert len(links) == 39 and {b for _, b in links} == {0}


def test_simhash_of_odd_rows(spark):
    rows = simhash_groups(odd(spark)).collect()
    assert len(rows) == len(TEXTS)
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {4} and len(zero) == 4
    same = {r.component_id for r in rows if r.fingerprint == f"{plain_fingerprint(sentence(1, 40)):016x}"}
    assert same == {1}
    assert {r.component_id for r in rows if r.doc_id in (8, -3)} == {-3}
    assert simhash_groups(empty(spark)).collect() == []
    left = drop_near_copies(odd(spark))
    assert left.columns == odd(spark).columns
    kept = [r[0] for r in left.collect()]
    assert {1, 2, 4, -3} <= set(kept) and not {3, 5, 6, 8} & set(kept)
    assert drop_near_copies(empty(spark)).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, n) for n in range(1001, 1300)] + [(5, 5)]
    random.Random(2).shuffle(edges)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none).collect() == []


def test_digest_of_the_query_is_of_the_text(spark, sf_dir):
    got = {r.doc_id: r.text_sha256 for r in QUERIES["op8_exact_dedup"](spark, sf_dir).collect()}
    assert got == {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in documents(sf_dir)}


def test_the_membership_filter_is_sized_by_its_keys(spark):
    from tarn.llm.common import LEAST_SLOTS, SLOTS_PER_KEY, filter_pages, flag_members

    keys = spark.range(0, 20_000, 2)
    held = filter_pages(keys)
    assert SLOTS_PER_KEY * 10_000 <= held.slots < 2 * SLOTS_PER_KEY * 10_000
    rows = flag_members(spark.range(20_000), [F.col("id")], held, "maybe").collect()
    assert all(r.maybe for r in rows if r.id % 2 == 0)
    assert sum(r.maybe for r in rows if r.id % 2) < 1_500
    # More keys than slots: rows pass that need not, and none is lost.
    small = filter_pages(spark.range(0, 200_000, 2), most_slots=LEAST_SLOTS)
    assert small.slots == LEAST_SLOTS
    rows = flag_members(spark.range(20_000), [F.col("id")], small, "maybe").collect()
    assert all(r.maybe for r in rows if r.id % 2 == 0)
    assert filter_pages(spark.range(0)).slots == LEAST_SLOTS
