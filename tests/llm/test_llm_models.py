"""The quality classifier, mixing, document fingerprints and the pipeline."""

from __future__ import annotations

import hashlib
import math
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from oddities import TEXTS, empty, frame, odd, sentence
from pyspark.sql import functions as F

from tarn.llm import quality
from tarn.llm.common import BATCH_ROWS_CONF
from tarn.llm.imatch import Fingerprints, edit_likeness, fingerprints, lexicon, likeness, term_hash
from tarn.llm.mixing import _rates, fit_rates, mix, mixing_rates
from tarn.llm.models import fit
from tarn.llm.ngrams import (
    Featurizer,
    FollowTheRegularizedLeader,
    counted,
    margin,
    sigmoid,
)
from tarn.llm.quality import classify, keep_good, train_quality
from tarn.llm.queries import LANGUAGE_TARGETS, QUERIES
from tarn.llm.simhash import fingerprint


def fetch(sf_dir, sql):
    return duckdb.connect().execute(sql.format(sf_dir)).fetchall()


def plain_ftrl(examples, epochs, bits):
    """FTRL-proximal as published, one coordinate at a time, in plain Python."""
    alpha, beta, l1, l2 = 1.0, 1.0, 0.02, 0.1
    z, n = {}, {}

    def weight(i):
        pull = z.get(i, 0.0)
        if abs(pull) <= l1:
            return 0.0
        rate = (beta + math.sqrt(n[i])) / alpha + l2
        return -(pull - math.copysign(l1, pull)) / rate

    for _ in range(epochs):
        for buckets, shares, label in examples:
            pairs = [(int(i), float(x)) for i, x in zip(buckets, shares, strict=True)]
            now = {i: weight(i) for i, _ in pairs}
            chance = 1 / (1 + math.exp(-sum(now[i] * x for i, x in pairs)))
            for i, x in pairs:
                gradient, before = (chance - label) * x, n.get(i, 0.0)
                after = before + gradient * gradient
                sigma = (math.sqrt(after) - math.sqrt(before)) / alpha
                z[i] = z.get(i, 0.0) + gradient - sigma * now[i]
                n[i] = after
    weights = np.zeros(1 << bits)
    for i in z:
        weights[i] = weight(i)
    return weights


def test_quality_query_on_held_out_labels(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, sf_dir).collect()}
    docs = dict(fetch(sf_dir, "SELECT doc_id, text FROM '{}/documents.parquet'"))
    assert set(rows) == set(docs)
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = fetch(sf_dir, "SELECT doc_id, quality FROM '{}/labels.parquet'")
    held = [(rows[d].predicted, q) for d, q in labels if rows[d].held_out]
    good = [p for p, q in held if q == 1]
    bad = [p for p, q in held if q == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_labels_are_never_learned(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = frame(spark, [(i, sentence(i, 30)) for i in ids])
    weights = train_quality(docs, labels_of(spark, [(i, i % 2, 0) for i in ids]))
    assert not weights.any()


def test_quality_of_odd_rows(spark):
    labels = labels_of(spark, [(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 1), (10, 1, 0), (10, 0, 0)])
    rows = classify(odd(spark), labels).collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    same = {r.score for r, (_, t) in zip(rows, TEXTS, strict=True) if not t}
    assert len(same) == 1
    assert classify(empty(spark), labels).collect() == []
    none = labels_of(spark, [])
    assert {r.score for r in classify(odd(spark), none).collect()} == {0.5}
    kept = keep_good(odd(spark), labels)
    assert kept.columns == odd(spark).columns
    assert {r[9] for r in kept.collect()} <= {0.5}  # its own score column is untouched


def test_margin_is_the_sparse_dot_product():
    made = Featurizer()
    weights = np.linspace(-1, 1, 1 << 18).astype(np.float32)
    for _, text in TEXTS:
        buckets, _ = made.of(text or "")
        index, values = counted(buckets)
        assert margin(weights, buckets) == pytest.approx(float(weights[index] @ values), abs=1e-3)


def test_ftrl_separates_and_keeps_weights_sparse():
    rng = np.random.default_rng(3)
    examples = []
    for n in range(600):
        label = n % 2
        index = np.unique(np.concatenate(([0, 10 + label], rng.integers(100, 60_000, 5))))
        examples.append((index, np.ones(len(index)), float(label)))
    model = FollowTheRegularizedLeader()
    for _ in range(3):
        for example in examples:
            model.learn(*example)
    weights = model.weights()
    assert weights == pytest.approx(plain_ftrl(examples, 3, 18), abs=1e-9)
    assert sigmoid(weights[0] + weights[11]) > 0.9 > 0.1 > sigmoid(weights[0] + weights[10])
    assert np.count_nonzero(weights) < 4_000


def test_the_quality_sample_is_the_documented_one(spark, monkeypatch):
    usable = [i for i in range(18_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(usable) > 12_000
    docs = spark.range(18_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    sizes = []

    def counting(sample, classes, epochs, featurizer):
        sizes.append(sample.count())
        return np.zeros((1, 1 << 18), np.float32)

    monkeypatch.setattr(quality, "fit", counting)
    for n in (9_000, 18_000):
        train_quality(docs, spark.range(n).selectExpr("id AS doc_id", "id % 2 AS quality"))
    assert sizes == [sum(i < 9_000 for i in usable), 12_000]


def test_streamed_epochs_learn_what_one_pass_in_memory_does(spark):
    rows = [(i, i % 3, sentence(i, 20)) for i in range(120)]
    sample = spark.createDataFrame(rows, "id bigint, label int, text string")
    order = [r.id for r in sample.orderBy(F.xxhash64("id", F.lit(1)), "id").collect()]
    made = Featurizer(bits=12)
    features = {i: counted(made.of(text)[0]) for i, _, text in rows}
    was = spark.conf.get(BATCH_ROWS_CONF)
    spark.conf.set(BATCH_ROWS_CONF, 7)
    try:
        weights = fit(sample, [0, 1, 2], 3, {"bits": 12})
    finally:
        spark.conf.set(BATCH_ROWS_CONF, was)
    for value in range(3):
        plain = [
            (features[i][0], features[i][1].astype(np.float32), float(i % 3 == value)) for i in order
        ]
        assert weights[value] == pytest.approx(plain_ftrl(plain, 3, 12), abs=1e-6)


def test_mixing_query_meets_its_targets(spark, sf_dir):
    rows = QUERIES["op2_source_mixing"](spark, sf_dir).collect()
    ids = [d for (d,) in fetch(sf_dir, "SELECT doc_id FROM '{}/documents.parquet'")]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    chances = np.array([r.posterior for r in rows])
    tokens = np.array([r.n_tokens for r in rows], float)
    rates = np.array([r.rate for r in rows])
    assert rates.min() >= 0 and np.allclose(chances.sum(axis=1), 1)
    expected = (rates * tokens) @ chances
    targets = np.array(list(LANGUAGE_TARGETS.values())) * tokens.sum()
    assert expected == pytest.approx(targets, rel=0.005)
    assert all(abs(r.copies - r.rate) <= 1 for r in rows)
    assert sum(r.copies for r in rows) == pytest.approx(rates.sum(), rel=0.1)
    languages = dict(fetch(sf_dir, "SELECT doc_id, lang FROM '{}/documents.parquet'"))
    names = list(LANGUAGE_TARGETS)
    right = [names[int(np.argmax(r.posterior))] == languages[r.doc_id] for r in rows if r.n_tokens > 20]
    assert np.mean(right) > 0.95


def test_rates_are_the_least_squares_ones(spark):
    """Against projected gradient on the whole system in numpy, run much longer."""
    rng = np.random.default_rng(7)
    chances = rng.dirichlet([0.4, 0.4, 0.4], 300)
    tokens = rng.integers(0, 500, 300)
    members = spark.createDataFrame(
        [(i, int(t), [float(x) for x in p]) for i, (t, p) in enumerate(zip(tokens, chances, strict=True))],
        "doc_id bigint, n_tokens bigint, posterior array<double>",
    ).cache()
    for shares in (np.array([0.6, 0.3, 0.1]), np.array([0.78, 0.11, 0.11])):
        fit = fit_rates(members, shares)
        rates, _ = _rates(chances, fit)
        assert 0 <= rates.min() < 0.01
        targets = shares * tokens.sum()
        error = np.linalg.norm((rates * tokens) @ chances - targets)
        best = np.full(300, fit.start)
        pull = chances * tokens[:, None]
        for _ in range(20_000):
            residual = (best * tokens) @ chances - targets
            best = np.maximum(0, best - pull @ residual / np.linalg.norm(pull, 2) ** 2)
        least = np.linalg.norm((best * tokens) @ chances - targets)
        assert error <= least + 0.001 * tokens.sum()


@pytest.mark.parametrize("shares", [[0.1, 0.1, 0.1, 0.7], [0.5, 0.2, 0.2, 0.1], [0.03, 0.9, 0.03, 0.04]])
def test_rates_that_keep_all_are_the_least_squares_ones(spark, shares):
    """Against projected gradient on the whole system, with restarts and run much longer."""
    rng = np.random.default_rng(11)
    domain = rng.choice(4, 400, p=[0.55, 0.25, 0.15, 0.05])
    odds = np.exp(rng.normal(0, 1, (400, 4)) + 5 * np.eye(4)[domain])
    chances = odds / odds.sum(axis=1)[:, None]
    tokens = rng.integers(0, 2_000, 400)
    members = spark.createDataFrame(
        [(i, int(t), [float(x) for x in p]) for i, (t, p) in enumerate(zip(tokens, chances, strict=True))],
        "doc_id bigint, n_tokens bigint, posterior array<double>",
    ).cache()
    shares = np.array(shares)
    rates, _ = _rates(chances, fit_rates(members, shares, keep_all=True))
    assert rates.min() >= 1
    pull = (chances * tokens[:, None]).T
    targets = shares * (pull.sum(axis=1) / shares).max()
    gram = pull @ chances
    root = np.linalg.cholesky(np.linalg.inv(gram + 1e-6 * np.trace(gram) * np.eye(4))).T
    best = ahead = np.ones(400)
    whole, at = np.linalg.inv(gram + 1e-6 * np.trace(gram) * np.eye(4)), 0
    for _ in range(100_000):
        slope = chances @ (whole @ (pull @ ahead - targets))
        before, best = best, np.maximum(1, ahead - slope)
        at = 0 if (slope * tokens) @ (best - before) > 0 else at + 1
        ahead = best + at / (at + 3) * (best - before)
    error, least = (np.linalg.norm(root @ (pull @ r - targets)) for r in (rates, best))
    assert error <= 1.001 * least + 1e-4 * np.linalg.norm(root @ targets)
    off, least_off = (np.abs(pull @ r / targets - 1).max() for r in (rates, best))
    assert off <= least_off + 0.002


def test_targets_out_of_reach_are_neared(spark):
    chances = np.array([[0.9, 0.1], [0.5, 0.5], [0.3, 0.7]])
    members = spark.createDataFrame(
        [(i, 100, [float(x) for x in p]) for i, p in enumerate(chances)],
        "doc_id bigint, n_tokens bigint, posterior array<double>",
    )
    rates, _ = _rates(chances, fit_rates(members, np.array([1.0, 0.0])))
    assert rates[0] > 2.5 and rates[1:].max() < 0.2
    kept, _ = _rates(chances, fit_rates(members, np.array([1.0, 0.0]), keep_all=True))
    assert kept.min() == 1.0


def test_mixing_odd_rows(spark):
    labelled = spark.createDataFrame([(1, "a"), (2, "b"), (10, "a"), (None, "b"), (3, None), (4, "c")], "doc_id bigint, domain string")
    targets = {"a": 1.0, "b": 1.0}
    rows = mixing_rates(odd(spark), labelled, targets).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert mixing_rates(empty(spark), labelled, targets).collect() == []
    mixed = mix(odd(spark), labelled, targets, keep_all=True)
    assert mixed.columns == odd(spark).columns
    copies = {r.doc_id: r.copies for r in mixing_rates(odd(spark), labelled, targets, keep_all=True).collect()}
    got = [r[0] for r in mixed.collect()]
    for doc_id in (1, 2, 3, 7, 9, 10):
        assert got.count(doc_id) == copies[doc_id]
    assert got.count(None) == 2


def plain_edits(docs):
    docs = sorted(docs)
    for n, (doc_id, text) in enumerate(docs):
        following = docs[(n + 1) % len(docs)][1]
        cut = len(text) // 4
        yield doc_id, text, text[: len(text) - cut] + following[:cut], following


def test_fingerprint_query(spark, sf_dir):
    docs = fetch(sf_dir, "SELECT doc_id, coalesce(text, '') FROM '{}/documents.parquet'")
    rows = {r.doc_id: r for r in QUERIES["op10_document_fingerprints"](spark, sf_dir).collect()}
    assert set(rows) == {d for d, _ in docs}
    prints = Fingerprints(lexicon(spark.createDataFrame(docs, "doc_id bigint, text string")))
    by_text = {}
    for doc_id, text, edited, following in plain_edits(docs):
        r = rows[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (prints.of(text), prints.of(edited))
        assert r.near_edited == likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == likeness(r.fingerprint, prints.of(following))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    near = np.array([(r.near_edited, r.near_next) for r in rows.values()])
    assert near[:, 0].mean() > 0.4 > 0.05 > near[:, 1].mean()
    assert (near[:, 0] > near[:, 1]).mean() > 0.97


def test_lexicon_is_the_band(spark):
    texts = [(i, f"common pair{i // 2} only{i} {'third' if i % 3 == 0 else ''}") for i in range(30)]
    found = set(lexicon(spark.createDataFrame(texts, "doc_id bigint, text string"), low=0.01, high=0.4).tolist())
    assert found == {term_hash(w) for w in ["third", *[f"pair{i}" for i in range(15)]]}


def test_fingerprints_of_odd_rows(spark):
    rows = edit_likeness(odd(spark)).collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t in TEXTS)
    assert {r.near_edited for r in rows if r.n_chars < 4} == {1.0}
    assert edit_likeness(empty(spark)).collect() == []
    alone = frame(spark, [(5, "abcd efgh")])
    (row,) = edit_likeness(alone).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest() and row.near_next == 1.0
    same = {r.fingerprint for r in fingerprints(odd(spark)).collect() if r.doc_id in (1, 3)}
    assert len(same) == 1


def heads(prints):
    """The least id of each group of fingerprints linked at two bits or fewer."""
    ids = np.array(sorted(prints))
    marks = np.array([prints[i] for i in ids.tolist()], np.uint64)
    linked = [np.flatnonzero(np.bitwise_count(marks ^ mark) <= 2) for mark in marks]
    seen, found = np.zeros(len(ids), bool), set()
    for n, doc_id in enumerate(ids.tolist()):
        if not seen[n]:
            found.add(doc_id)
            todo = [n]
            while todo:
                near = linked[todo.pop()]
                todo.extend(near[~seen[near]].tolist())
                seen[near] = True
    return found


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "SimHash near-dedup", "mixing to target weights", "best-fit packing"]
    stages = dict(corpus_pipeline.STAGES)
    predicted = {r.doc_id: r.predicted for r in QUERIES["op4_quality_classifier"](spark, sf_dir).collect()}
    good = corpus_pipeline.stored(stages[names[0]](spark, docs, sf_dir))
    assert good.columns == columns
    texts = {r.doc_id: r.text for r in good.collect()}
    assert set(texts) == {d for d, p in predicted.items() if p}
    distinct = corpus_pipeline.stored(stages[names[1]](spark, good, sf_dir))
    last = {}
    for doc_id, text in texts.items():
        last[text] = max(doc_id, last.get(text, doc_id))
    left = {r.doc_id: r.text for r in distinct.collect()}
    assert distinct.columns == columns and set(left) == set(last.values())
    single = corpus_pipeline.stored(stages[names[2]](spark, distinct, sf_dir))
    prints = {doc_id: fingerprint(text.encode()) for doc_id, text in left.items()}
    kept = {r.doc_id for r in single.collect()}
    assert single.columns == columns and kept == heads(prints)
    mixed = corpus_pipeline.stored(stages[names[3]](spark, single, sf_dir))
    assert mixed.columns == columns
    ids = [r.doc_id for r in mixed.select("doc_id").collect()]
    assert set(ids) == kept and len(ids) > len(kept)
    packed = stages[names[4]](spark, mixed, sf_dir).collect()
    assert sum(r.piece == 0 for r in packed) == len(ids)


def test_pipeline_runs_whole(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048
    assert len(fill) <= 1.01 * -(-sum(fill.values()) // 2048)
