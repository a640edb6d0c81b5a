"""Runs of repeated words: stretches that keep a period for four rounds or more.

A run is a stretch of words with smallest period q, at least ``LEAST_ROUNDS`` * q
and ``LEAST_WORDS`` long, that neither neighbour extends. Periods up to ``SHORT``
are found by scanning every lag. Longer ones are found by minimizers, scale by
scale: at scale c every window of c grams of c words has a least gram, by hash.
Inside a run whose period is at most c and at least two thirds of it, a window
holds each gram of the period once, so the window minima repeat at the period's
distance: two neighbouring minima with the same gram are a seed. A seed is
extended word by word to both sides, and what it grows to is a run or is not.

Hashes decide only where to look. Two different grams of one hash would show as
a seed whose words differ; the lags of that scale are then scanned one by one,
so the runs found are all runs, whatever the hashes.

Documents are scanned together, those of a batch one after the other with marks
in between, the longest first: a scale looks only at documents long enough for
its periods.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, values

# What counts as a run, by the operator's contract.
LEAST_ROUNDS = 4
LEAST_WORDS = 6
# Periods that are found by scanning their lag.
SHORT = 8
# Words that are scanned together; a longer document is scanned alone.
WORDS_TOGETHER = 400_000

# An odd base and its inverse modulo 2**64, for hashes of grams.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

Run = tuple[int, int, int]  # start, length, period


def scales(longest: int) -> list[tuple[int, int]]:
    """``(least period, gram size)`` of each scale for texts of ``longest`` words.

    Two windows of c grams of c words, one period apart, must fit in a run of
    four periods: 2c - 1 + q <= 4q.
    """
    found, period = [], SHORT + 1
    while LEAST_ROUNDS * period <= longest:
        size = ((LEAST_ROUNDS - 1) * period + 1) // 2
        found.append((period, size))
        period = size + 1
    return found


def _mix(values: np.ndarray) -> np.ndarray:
    """Numbers to well-spread 64-bit hashes."""
    mixed = (values + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    if n:
        factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _least_of_next(hashes: np.ndarray, window: int) -> np.ndarray:
    """The least of every ``window`` neighbours, by doubling."""
    least, covered = hashes, 1
    while covered * 2 <= window:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    rest = window - covered
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _same_ahead(words: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on equal those ``lag`` later."""
    step, done = 64, 0
    while True:
        ours = words[at + done : at + done + step]
        later = words[at + done + lag : at + done + lag + step]
        ours = ours[: len(later)]
        if not len(ours):
            return done
        differ = ours != later
        if differ.any():
            return done + int(differ.argmax())
        done += len(ours)
        step *= 2


def _same_behind(words: np.ndarray, at: int, lag: int) -> int:
    """How many words before ``at`` equal those ``lag`` later."""
    step, done = 64, 0
    while True:
        low = max(0, at - done - step)
        differ = words[low : at - done] != words[low + lag : at - done + lag]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done = at - low
        if not low:
            return done
        step *= 2


def _scan_lag(words: np.ndarray, lag: int, found: dict[tuple[int, int], int]) -> None:
    """Runs of period ``lag`` by comparing every word with the one ``lag`` later.

    A stretch that also keeps a shorter period is a run of that one, which was
    found before.
    """
    if len(words) <= lag:
        return
    same = np.zeros(len(words) - lag + 2, np.int8)
    same[1:-1] = words[:-lag] == words[lag:]
    turns = np.diff(same)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = ends - starts + lag >= max(LEAST_WORDS, LEAST_ROUNDS * lag)
    for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        found.setdefault((start, end + lag), lag)


def _scan_scale(
    words: np.ndarray, grams: np.ndarray, period: int, size: int, found: dict[tuple[int, int], int]
) -> None:
    """Runs with periods of ``period`` to ``size``, seeded by equal window minima."""
    least = _least_of_next(grams[1:], size)
    ahead = grams[: len(least)]
    seeds = np.flatnonzero(ahead == least)
    at = 0
    while at < len(seeds):
        seed = int(seeds[at])
        lag = 1 + int((grams[seed + 1 : seed + 1 + size] == grams[seed]).argmax())
        right = _same_ahead(words, seed, lag)
        if right < size:
            # Two grams of one hash: look at all lags of the scale instead.
            for each in range(period, size + 1):
                _scan_lag(words, each, found)
            return
        start, end = seed - _same_behind(words, seed, lag), seed + right + lag
        if end - start >= max(LEAST_WORDS, LEAST_ROUNDS * lag):
            found.setdefault((start, end), lag)
        # Seeds whose grams lie in this stretch would grow to it again.
        at = max(at + 1, int(np.searchsorted(seeds, end - lag - size, "right")))


def runs_of(words: np.ndarray, lengths: list[int]) -> list[Run]:
    """All runs in ``words``: documents of ``lengths``, longest first.

    After each document stands a number that no other place has.
    """
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, SHORT + 1):
        _scan_lag(words, lag, found)
    held = np.array(lengths, np.int64)
    ends = np.cumsum(held + 1)
    plan = scales(int(held[0]) if len(held) else 0)
    if plan:
        reach = int(ends[np.searchsorted(-held, -LEAST_ROUNDS * plan[0][0], "right") - 1])
        up, down = _powers(BASE, reach), _powers(INVERSE, reach)
        sums = np.zeros(reach + 1, np.uint64)
        np.cumsum(_mix(words[:reach].view(np.uint64)) * up, out=sums[1:])
    for period, size in plan:
        documents = int(np.searchsorted(-held, -LEAST_ROUNDS * period, "right"))
        reach = int(ends[documents - 1])
        grams = (sums[size : reach + 1] - sums[: reach + 1 - size]) * down[: reach + 1 - size]
        grams = _mix(grams)
        if len(grams) > size:
            _scan_scale(words[:reach], grams, period, size, found)
    return [(start, end - start, lag) for (start, end), lag in found.items()]


class Places(dict):
    """Numbers the words it is asked for, from 0 on."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _digests(words: list[bytes], runs: list[Run]) -> tuple:
    """The output columns of one document after its id."""
    runs = sorted((start, period, length) for start, length, period in runs)
    listed = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
    if runs:
        start, period, length = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]))
        top = (start, length, period, 1000 * length // period)
        keep = np.ones(len(words), bool)
        for start, period, length in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    else:
        top = (None,) * 4
    return (
        len(runs),
        *top,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(words)).hexdigest(),
    )


SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
KINDS = [pa.int64()] * 6 + [pa.string()] * 2


def _scan_together(documents: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document, from one scan over all of them."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    lengths = [len(documents[i]) for i in order]
    ends = np.cumsum(np.array(lengths, np.int64) + 1)
    words = np.empty(int(ends[-1]), np.int64)
    places = Places()
    for i, length, end in zip(order, lengths, ends.tolist(), strict=True):
        words[end - 1 - length : end - 1] = np.fromiter(
            map(places.__getitem__, documents[i]), np.int64, length
        )
        words[end - 1] = -end
    runs: list[list[Run]] = [[] for _ in documents]
    for start, length, period in runs_of(words, lengths):
        rank = int(np.searchsorted(ends, start, "right"))
        first = int(ends[rank]) - 1 - lengths[rank]
        runs[order[rank]].append((start - first, length, period))
    return runs


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, documents, held = [], [], 0

    def out() -> pa.RecordBatch:
        found = _scan_together(documents)
        rows = [
            (doc_id, *_digests(words, runs))
            for doc_id, words, runs in zip(ids, documents, found, strict=True)
        ]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], NAMES
        )

    for batch in batches:
        for doc_id, text in zip(
            values(batch.column("doc_id")), values(batch.column("text")), strict=True
        ):
            # bytes.split cuts at 0x20 and 0x09-0x0D.
            words = text.split()
            if documents and held + len(words) > WORDS_TOGETHER:
                yield out()
                ids, documents, held = [], [], 0
            ids.append(doc_id)
            documents.append(words)
            held += len(words)
    if documents:
        yield out()


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: how many runs its words hold, the strongest, digests.

    ``start, length, period, exponent_milli`` are of the run with the greatest
    length / period (then the least start, then the least period), and null
    without runs. ``runs_sha256`` digests all runs, ``collapsed_sha256`` the
    words that are left when of every run only the first period stays.

    Words are cut at ASCII white space and compared byte by byte. A null text
    is an empty one: no words, no runs, the digests of nothing. Rows that
    repeat an id, and rows without one, are rows like others. An empty table
    gives no rows; further columns do not matter.
    """
    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), body("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(_scan, SCHEMA)


def planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's input: some documents repeat a stretch of their words to the end.

    With n words, h = crc32(decimal doc_id) and g = floor(h / 10), a text with
    h % 10 = 0 keeps its first a = g % n words and then repeats the next
    1 + floor((n - a) / (3 + g % 8)) of them. Other texts, and those of a null
    id, stay as they are.
    """
    word_list = F.filter(
        F.split(body("text"), r"[\x20\x09-\x0D]+"), lambda word: word != F.lit("")
    )
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n = F.size("words").cast("bigint")
    g = F.floor(F.col("h") / 10)
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    kept = F.slice("words", F.lit(1), F.col("a").cast("int"))
    rest = (F.col("n") - F.col("a")).cast("int")
    cycle = F.slice("words", F.col("a").cast("int") + 1, F.col("p"))
    rounds = F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int")))
    repeats = F.concat(kept, F.slice(rounds, F.lit(1), rest))
    chosen = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return (
        docs.select("doc_id", "text", hashed.alias("h"))
        .withColumn("words", F.when(F.col("h") % 10 == 0, word_list))
        .select("doc_id", "text", "h", "words", n.alias("n"), g.alias("g"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", p)
        .select("doc_id", F.when(chosen, F.array_join(repeats, " ")).otherwise(F.col("text")).alias("text"))
    )
