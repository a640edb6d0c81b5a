"""Periodic runs against brute force: every lag of every text."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from oddities import TEXTS, empty, odd
from tarn.llm import runs as module
from tarn.llm.queries import QUERIES
from tarn.llm.runs import find_runs, runs_of


def brute(words):
    """(start, length, period) of all runs, by their definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q) and (start, length) not in found:
                found[(start, length)] = q
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(words):
    found = brute(words)
    listed = sorted((s, q, length) for s, length, q in found)
    text = "".join(f"{s},{length},{q}\n" for s, q, length in listed)
    drop = set()
    for s, length, q in found:
        drop.update(range(s + q, s + length))
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    top = (None,) * 4
    if found:
        s, length, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        top = (s, length, q, 1000 * length // q)
    return (
        len(found), *top, hashlib.sha256(text.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def scan(words):
    marked = np.array([*words, -1], np.int64)
    return sorted(runs_of(marked, [len(words)]))


def texts(seed, count=150, letters=3, longest=260):
    """Words over few letters with planted repetitions, some of them broken."""
    pick = random.Random(seed)
    for _ in range(count):
        words = [pick.randrange(letters) for _ in range(pick.randrange(longest))]
        for _ in range(pick.randrange(4)):
            cycle = [pick.randrange(letters) for _ in range(pick.randrange(1, 40))]
            size = pick.randrange(len(cycle), 7 * len(cycle) + 2)
            at = pick.randrange(len(words) + 1)
            words[at:at] = (cycle * 8)[:size]
        if words and pick.random() < 0.3:
            words[pick.randrange(len(words))] = letters
        yield words


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_against_brute_force(letters):
    for words in texts(letters, letters=letters):
        assert scan(words) == brute(words), words


def test_runs_of_runs_and_of_long_periods():
    block = [1, 1, 1, 1, 1, 1, 2]
    pick = random.Random(5)
    long = [pick.randrange(9) for _ in range(1500)]
    for words in (block * 9, (block * 4 + [3]) * 5, long * 4, long * 4 + long[:7], long * 3):
        assert scan(words) == brute(words)
    assert (0, 6000, 1500) in scan(long * 4)


def test_hashes_decide_nothing(monkeypatch):
    """With hashes of a few values every scale falls back to its lags."""
    weak = module._mix
    monkeypatch.setattr(module, "_mix", lambda values: weak(values) % np.uint64(3))
    for words in texts(7, count=60):
        assert scan(words) == brute(words)


def test_documents_scanned_together_stay_apart():
    documents = [[str(w).encode() for w in words] for words in texts(11, count=40)]
    same = [b"a"] * 30
    documents += [same, same, [], same]
    for words, found in zip(documents, module._scan_together(documents), strict=True):
        assert sorted(found) == brute(words)


def test_one_word_repeated_is_linear():
    assert scan([0] * 300_000) == [(0, 300_000, 1)]
    cycle = list(range(5_000))
    assert scan(cycle * 40) == [(0, 200_000, 5_000)]


def test_odd_rows(spark):
    out = find_runs(odd(spark)).collect()
    assert len(out) == len(TEXTS)
    got = sorted((tuple(r) for r in out), key=str)
    plain = [t for t in TEXTS if len(t[1] or "") < 100_000]
    for doc_id, text in plain:
        assert (doc_id, *expected((text or "").encode().split())) in got
    assert find_runs(empty(spark)).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        if n < 3000:
            assert rows[doc_id] == expected(words), doc_id
    assert planted > 5
