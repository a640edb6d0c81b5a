"""Near duplicates against brute force: every pair of sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from oddities import TEXTS, empty, frame, odd
from tarn.llm import chosen_path as module
from tarn.llm.chosen_path import exact_links, near_duplicates
from tarn.llm.queries import QUERIES


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(
        b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))
    )


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = [shingle_set(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    holders = {}
    for i, held in enumerate(sets):
        seen = set()
        for shingle in held:
            seen.update(holders.setdefault(shingle, []))
            holders[shingle].append(i)
        for j in seen:
            both = len(held & sets[j])
            if 100 * both >= 80 * (len(held) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(
        ((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def rows_of(out):
    rows = out.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def families(seed, count=25, most=25):
    """Texts in families of edits of one base, in chains of edits, and with a passage."""
    pick = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for family in range(count):
        words = [f"w{pick.randrange(3000)}" for _ in range(pick.randrange(20, 160))]
        texts.append(words)
        kin = words
        for _ in range(pick.randrange(most)):
            edited = list(kin if family % 2 else words)
            for _ in range(pick.randrange(1, 3)):
                edited[pick.randrange(len(edited))] = f"e{pick.randrange(10**6)}"
            texts.append(edited)
            kin = edited
    texts += [passage + [f"u{pick.randrange(10**6)}" for _ in range(40)] for _ in range(60)]
    texts += [list(texts[0]) for _ in range(30)]
    pick.shuffle(texts)
    return [(i * 3 - 5, " ".join(words)) for i, words in enumerate(texts)]


@pytest.mark.parametrize(
    ("small", "task_classes"), [(512, 4096), (6, 4096), (6, 10)]
)
def test_components_against_brute_force(spark, small, task_classes):
    """Also where nodes are large and groups are compared block by block."""
    rows = families(small + task_classes)
    out = near_duplicates(frame(spark, rows), small=small, task_classes=task_classes)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows_of(out) == brute(rows)


def test_links_at_the_threshold():
    """100 x intersection >= 80 x union, and not a word less."""
    base = np.arange(90, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    base = np.sort(base)
    assert module.linked(base[:80], np.sort(base[:80])) and module.linked(base[:72], base)
    assert not module.linked(base[:71], base)
    ten = base[:10]
    assert module.linked(ten[:9], ten[1:]) is (100 * 8 >= 80 * 10)
    assert exact_links([ten[:9], ten[1:]]) in ([(0, 1)], [])


def test_odd_rows(spark):
    assert rows_of(near_duplicates(odd(spark))) == brute(TEXTS)
    assert near_duplicates(empty(spark)).collect() == []


def test_a_large_group_costs_one_edge_each(spark):
    """Near copies of one text: candidates and links stay fewer than members."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(700):
        edited = list(words)
        edited[pick.randrange(200)] = f"e{i}"
        rows.append((i, " ".join(edited)))
    keys = [shingle_set(text) for _, text in rows]
    sets = [module.shingles(text.encode()) for _, text in rows]
    assert [len(s) for s in sets] == [len(k) for k in keys]
    assert len(exact_links(sets)) == len(rows) - 1
    out = near_duplicates(frame(spark, rows), small=100)
    assert {r.component_id for r in out.collect()} == {0}


def test_query_against_brute_force(spark, sf_dir):
    got = rows_of(QUERIES["op13_minhash_near_dedup"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([tuple(r) for r in docs])
