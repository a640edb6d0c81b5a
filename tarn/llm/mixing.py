"""Mixing to target weights by soft domain membership.

A classifier learned from a labelled table gives every document posteriors over
the domains. Rates, how often each document is used, are then fitted: the
expected tokens of a domain are the sum over documents of rate x tokens x
posterior, and the rates, never below the lowest one, bring them to the targets
in the least squares sense, by projected gradient.

The gradient at a document's rate is the product of its posteriors with one
number per domain, which come from the domains' residuals. So a step is: sum up
the expected tokens (one aggregation to a few numbers per domain, for several
step lengths at once), turn the residuals into these numbers, move every rate
against its gradient, and put those that fall below the lowest rate back on it.
A rate is a function of the document's posteriors and the steps taken; every
``STEPS_HELD`` steps the rates are written, so that few are taken again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, filter_pages, flag_members, hold, picked, release, stored, values
from tarn.llm.models import fit as fit_classes
from tarn.llm.models import labelled_sample
from tarn.llm.ngrams import Featurizer, margins, sigmoid

# Labelled documents that training uses at most, and passes over them.
MAX_LABELLED = 4_000
EPOCHS = 3
FEATURES = {"orders": 1, "shape_orders": 0, "bits": 17}
# Steps stop when every domain is this close to its target, or at the optimum. A
# step that gains less than ``SLOW`` of the error starts the descent anew, once,
# from the best single step; after that, one that gains less than ``LEAST_GAIN``
# ends it.
CLOSE = 1e-4
SLOW = 0.1
LEAST_GAIN = 0.001
# The best single step is found when no domain's tokens are further from what it
# asks than this share of all; how much its distance from equal rates weighs
# beside the error; and the shortest part of a change to it that is tried.
OPTIMAL = 1e-6
EQUAL_WEIGHT = 1e-10
LEAST_PART = 1e-6
# Step lengths that are tried together, and steps between two written tables.
LENGTHS = np.array([2.0, 1.0, 0.5, 0.25, 0.125, 1 / 16, 1 / 64, 1 / 256])
STEPS_HELD = 20

POSTERIOR_SCHEMA = "doc_id bigint, n_tokens bigint, posterior array<double>"


def posteriors(
    docs: DataFrame, labelled: DataFrame, domains: list[str], doc_id: str, text: str
) -> DataFrame:
    """``(doc_id, n_tokens, posterior)`` for every row, in the order of ``domains``."""
    known = (
        picked(labelled, id=doc_id, label="domain")
        .select(F.col("id").cast("bigint"), "label")
        .where(F.col("label").isin(domains))
    )
    sample = labelled_sample(docs, known, MAX_LABELLED, doc_id, text)
    weights = docs.sparkSession.sparkContext.broadcast(
        np.ascontiguousarray(fit_classes(sample, domains, EPOCHS, FEATURES).T)
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Featurizer(**FEATURES)
        for batch in batches:
            tokens, rows = [], []
            for content in values(batch.column("text")):
                buckets, n = maker.of(content)
                chances = np.array([sigmoid(m) for m in margins(weights.value, buckets).tolist()])
                tokens.append(n)
                rows.append(chances / chances.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(tokens, pa.int64()),
                    pa.array(rows, pa.list_(pa.float64())),
                ],
                ["doc_id", "n_tokens", "posterior"],
            )

    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), body("text").alias("text")
    )
    return rows.mapInArrow(apply, POSTERIOR_SCHEMA)


def _matrix(column: pa.Array, domains: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


@dataclass(frozen=True)
class Fit:
    """What makes a document's rate from its posteriors: the rate all start from,
    the lowest one, and the steps, each a number per domain."""

    start: float
    lowest: float
    steps: tuple[np.ndarray, ...] = ()


def _moved(rates: np.ndarray, chances: np.ndarray, step: np.ndarray, lowest: float) -> np.ndarray:
    """One projected step: against the gradient, and back to the lowest rate."""
    return np.maximum(lowest, rates - chances @ step)


def _rates(chances: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """The rates after all steps, and which of them are above the lowest."""
    rates = np.full(len(chances), fit.start)
    for step in fit.steps:
        rates = _moved(rates, chances, step, fit.lowest)
    return rates, rates > fit.lowest


def _taken(
    batch: pa.RecordBatch, domains: int, steps: list[np.ndarray], lowest: float
) -> tuple[np.ndarray, np.ndarray]:
    """The posteriors of a batch, and its rates after ``steps``."""
    chances = _matrix(batch.column("posterior"), domains)
    rates = batch.column("rate").to_numpy(zero_copy_only=False)
    for step in steps:
        rates = _moved(rates, chances, step, lowest)
    return chances, rates


class Descent:
    """The rates of ``members`` on their way, and sums over them."""

    def __init__(self, members: DataFrame, domains: int, start: float, lowest: float):
        self.state = members.select("n_tokens", "posterior", F.lit(start).alias("rate"))
        self.domains, self.lowest = domains, lowest
        self.held: list[np.ndarray] = []

    def sums(self, step: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each length of ``step``, the tokens per domain after it, and the
        token-weighted products, domain by domain, of the posteriors of
        documents whose rate is then above the lowest."""
        shape = (len(lengths), self.domains + 1, self.domains)
        domains, held, lowest = self.domains, list(self.held), self.lowest

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                chances, rates = _taken(batch, domains, held, lowest)
                tokens = batch.column("n_tokens").to_numpy(zero_copy_only=False)
                for n, length in enumerate(lengths.tolist()):
                    ahead = _moved(rates, chances, length * step, lowest)
                    free = tokens * (ahead > lowest)
                    total[n, 0] += (ahead * tokens) @ chances
                    total[n, 1:] += chances.T @ (chances * free[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                ["cell", "value"],
            )

        rows = (
            self.state.mapInArrow(add, "cell int, value double")
            .groupBy("cell")
            .agg(F.sum("value").alias("value"))
            .collect()
        )
        found = np.zeros(shape).ravel()
        for row in rows:
            found[row["cell"]] = row["value"]
        found = found.reshape(shape)
        return found[:, 0], found[:, 1:]

    def take(self, step: np.ndarray) -> None:
        """Move on by ``step``, and write the rates once enough steps are held."""
        self.held.append(step)
        if len(self.held) < STEPS_HELD:
            return
        domains, held, lowest = self.domains, self.held, self.lowest

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, rates = _taken(batch, domains, held, lowest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("n_tokens"), batch.column("posterior"), pa.array(rates)],
                    ["n_tokens", "posterior", "rate"],
                )

        self.state = stored(self.state.mapInArrow(move, self.state.schema))
        self.held = []


def best_single_step(
    members: DataFrame, targets: np.ndarray, start: float, lowest: float, gram: np.ndarray
) -> np.ndarray:
    """The step from equal rates that leaves the least error.

    Of the rates that meet the targets as nearly as any can, those nearest to
    equal ones are one projected step away from them, and the step is the
    optimum of a convex function made of finitely many quadratic pieces. Newton
    changes reach it, each shortened until the slope along it falls.
    """
    domains, one = len(targets), np.ones(1)
    total = targets.sum()
    near_equal = EQUAL_WEIGHT * (gram + 1e-6 * np.trace(gram) * np.eye(domains))
    equal = Descent(members, domains, start, lowest)
    step = np.zeros(domains)
    (tokens,), (free,) = equal.sums(step, one)
    while True:
        slope = near_equal @ step - (tokens - targets)
        if np.abs(slope).max() <= OPTIMAL * total:
            return step
        change = np.linalg.solve(free + near_equal, -slope)
        part = 1.0
        while True:
            ahead = step + part * change
            (tokens,), (free,) = equal.sums(ahead, one)
            left = near_equal @ ahead - (tokens - targets)
            if abs(left @ change) <= 0.9 * abs(slope @ change):
                break
            part /= 2
            if part < LEAST_PART:
                # Rounding is all that is left of the slope.
                return step
        step = ahead


def fit_rates(members: DataFrame, shares: np.ndarray, keep_all: bool = False) -> Fit:
    """Rates of ``members`` that meet ``shares`` as nearly as any can.

    The targets are ``shares`` of the corpus's tokens, and rates are at least
    zero; with ``keep_all`` they are shares of as many tokens as the most
    over-represented domain needs to stay whole, and rates are at least one.
    Residuals are weighted by the inverse of the posteriors' products, and
    targets that no rates can meet are met as nearly as these weights say.

    The descent begins at equal rates. A gradient is scaled so that a step of
    length one would meet the targets if the rates on the lowest one stayed
    there; the plain one is tried where that gains little. Targets at the edge
    of what rates can reach slow any descent down: it is then started anew from
    ``best_single_step``, an optimum but for rounding, and goes on from there
    for as long as a step gains anything to speak of.
    """
    domains = len(shares)
    none, one = np.zeros(domains), np.ones(1)
    (plain,), (gram,) = Descent(members, domains, 1.0, 0.0).sums(none, one)
    total = plain.sum()
    if not total:
        return Fit(1.0, 0.0)
    if keep_all:
        total = max(m / w for m, w in zip(plain, shares, strict=True) if w > 0)
    targets = shares * total
    whole = gram + 1e-6 * np.trace(gram) * np.eye(domains)
    weights = np.linalg.inv(whole)
    start, lowest = total / plain.sum(), 1.0 if keep_all else 0.0
    descent = Descent(members, domains, start, lowest)
    steps: list[np.ndarray] = []
    tokens, free, anew = start * plain, gram, False

    def error(expected: np.ndarray) -> float:
        return (expected - targets) @ weights @ (expected - targets)

    def tried(gradient: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """The least error along ``gradient``, the step to it, and the sums there."""
        ahead, products = descent.sums(gradient, LENGTHS)
        best = min(range(len(LENGTHS)), key=lambda n: error(ahead[n]))
        return error(ahead[best]), LENGTHS[best] * gradient, ahead[best], products[best]

    while True:
        residual = tokens - targets
        now = error(tokens)
        if np.all(np.abs(residual) <= CLOSE * np.maximum(targets, total * 1e-3)):
            return Fit(start, lowest, tuple(steps))
        slope = weights @ residual
        scaled = np.linalg.solve(free @ weights @ free + 1e-9 * whole, free @ slope)
        found = tried(scaled)
        if found[0] > (1 - SLOW) * now:
            found = min(found, tried(slope), key=lambda trial: trial[0])
        if found[0] > (1 - SLOW) * now and not anew:
            anew = True
            single = best_single_step(members, targets, start, lowest, gram)
            first = Descent(members, domains, start, lowest)
            (tokens_there,), (free_there,) = first.sums(single, one)
            if error(tokens_there) < now:
                descent, tokens, free = first, tokens_there, free_there
                descent.take(single)
                steps = [single]
                continue
        if found[0] > (1 - LEAST_GAIN) * now:
            return Fit(start, lowest, tuple(steps))
        _, step, tokens, free = found
        descent.take(step)
        steps.append(step)


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    keep_all: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, posterior, rate, copies``.

    ``labelled`` has the id and a text column ``domain``; labels that are null
    or name no target don't count. ``targets`` are weights, scaled to sum to
    one; ``posterior`` follows their order. ``copies`` rounds the rate to one
    of its neighbours by a hash of the id, in proportion, so that the sum of
    copies stays near the sum of rates.

    Null texts are empty: they have no tokens, weigh nothing, and keep the
    posterior of no evidence. Rows with null or repeated ids are rows like
    others. An empty table gives no rows; further columns do not matter.
    """
    names = list(targets)
    shares = np.array([targets[name] for name in names], float)
    members = stored(posteriors(docs, labelled, names, doc_id, text))
    fit = fit_rates(members, shares / shares.sum(), keep_all)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates, _ = _rates(_matrix(batch.column("posterior"), len(names)), fit)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rates)], [*batch.schema.names, "rate"]
            )

    rated = members.mapInArrow(apply, POSTERIOR_SCHEMA + ", rate double")
    chance = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("bigint"))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    keep_all: bool = False,
) -> DataFrame:
    """``docs`` with every row as often as its rate says, all columns kept.

    Only rows used other than once are shuffled. Rows with a null id are used
    once; of rows that repeat an id each is used as often as the first.
    """
    rates = stored(mixing_rates(docs, labelled, targets, doc_id, text, keep_all))
    other = (
        rates.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_mixed_id"))
        .agg(F.max("copies").alias("_copies"))
        .where("_copies <> 1")
    )
    key = F.col(f"_c{docs.columns.index(doc_id)}").cast("bigint")
    flagged = flag_members(hold(docs), [key], filter_pages(other.select("_mixed_id")), "_maybe")
    again = flagged.where("_maybe").join(other, key == F.col("_mixed_id"), "left")
    times = F.coalesce(F.col("_copies"), F.lit(1)).cast("int")
    repeated = again.withColumn("_once", F.explode(F.array_repeat(F.lit(0), times)))
    parts = [release(part, docs.columns) for part in (flagged.where("NOT _maybe"), repeated)]
    return parts[0].union(parts[1])
