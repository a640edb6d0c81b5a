"""Hashed word n-grams, and logistic regression on them by FTRL-proximal.

Both run inside tasks, a document at a time.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import xxhash

BITS = 18
# Feature 0 is the constant.
CONSTANT = 0

TOKENS = re.compile(r"\w+|[^\w\s]+")
# Tokens that a worker remembers, with hash and shape: about 30 MB.
KNOWN_TOKENS = 150_000

# How a token looks, as the word of a second sequence.
SHAPES = {"repeat": 1, "digits": 2, "mixed digits": 3, "upper": 4, "title": 5, "lower": 6}


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


def _shape(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return xxhash.xxh32_intdigest(token) | 1 << 32
    if token.isdigit():
        return SHAPES["digits"]
    if any(c.isdigit() for c in token):
        return SHAPES["mixed digits"]
    if len(token) > 1 and token.isupper():
        return SHAPES["upper"]
    return SHAPES["title"] if token[0].isupper() else SHAPES["lower"]


class Tokens(dict):
    """Maps a token to the bytes of its hash and shape; remembers the first it meets."""

    def __missing__(self, token: str) -> bytes:
        word = xxhash.xxh3_64_intdigest(token.lower().encode("utf-8", "replace"))
        pair = struct.pack("<QQ", word, _shape(token))
        if len(self) < KNOWN_TOKENS:
            self[token] = pair
        return pair


_known = Tokens()


class Featurizer:
    """Texts to hashed n-gram buckets."""

    def __init__(self, orders: int = 2, shape_orders: int = 3, bits: int = BITS):
        self.orders, self.shape_orders = orders, shape_orders
        self.shift = np.uint64(64 - bits)

    def of(self, text: str) -> tuple[np.ndarray, int]:
        """The bucket of every n-gram occurrence, and the number of tokens.

        N-grams of lower-cased tokens up to ``orders``, and of token shapes up
        to ``shape_orders``; a token equal to the one before has the shape
        ``repeat``.
        """
        tokens = TOKENS.findall(text)
        if not tokens:
            return np.zeros(0, np.int64), 0
        pairs = b"".join(map(_known.__getitem__, tokens))
        words, shapes = np.frombuffer(pairs, "<u8").reshape(-1, 2).T.copy()
        if self.shape_orders:
            shapes[1:][words[1:] == words[:-1]] = SHAPES["repeat"]
        found = []
        for sequence, orders, salt in (
            (words, self.orders, 0x9E3779B97F4A7C15),
            (shapes, self.shape_orders, 0xD1B54A32D192ED03),
        ):
            grams = np.full(len(sequence), salt, np.uint64)
            for n in range(orders):
                if n >= len(sequence):
                    break
                before = grams[: len(sequence) - n] * np.uint64(0x2545F4914F6CDD1D)
                grams = _mix(before + sequence[n:])
                found.append(grams >> self.shift)
        return np.concatenate(found).astype(np.int64), len(tokens)


# A document's features are its n-gram shares, times this.
SHARE_SCALE = 16.0


def counted(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their scaled shares, the constant first."""
    if not len(buckets):
        return np.array([CONSTANT]), np.ones(1)
    distinct, counts = np.unique(buckets, return_counts=True)
    shares = counts * (SHARE_SCALE / len(buckets))
    at = np.searchsorted(distinct, CONSTANT)
    if at < len(distinct) and distinct[at] == CONSTANT:
        distinct, shares = np.delete(distinct, at), np.delete(shares, at)
    return np.concatenate(([CONSTANT], distinct)), np.concatenate(([1.0], shares))


def margin(weights: np.ndarray, buckets: np.ndarray) -> float:
    """The sparse dot product of a document's features and the weights."""
    if not len(buckets):
        return float(weights[CONSTANT])
    taken = weights[buckets]
    taken = taken[buckets != CONSTANT] if weights[CONSTANT] else taken
    return float(weights[CONSTANT] + taken.sum() * (SHARE_SCALE / len(buckets)))


def margins(by_bucket: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """``margin`` for several classes, whose weights lie side by side: (buckets, classes)."""
    always = by_bucket[CONSTANT].astype(np.float64)
    if not len(buckets):
        return always
    taken = by_bucket.take(buckets[buckets != CONSTANT], axis=0)
    return always + taken.sum(axis=0, dtype=np.float64) * (SHARE_SCALE / len(buckets))


class FollowTheRegularizedLeader:
    """FTRL-proximal for logistic loss: per-coordinate rates, L1 and L2."""

    def __init__(
        self,
        bits: int = BITS,
        alpha: float = 1.0,
        beta: float = 1.0,
        l1: float = 0.02,
        l2: float = 0.1,
        state: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
    ):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        if state is not None:
            self.z[state[0]], self.n[state[0]] = state[1:]

    def state(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The buckets learned from and their numbers, from which learning goes on."""
        used = np.flatnonzero((self.z != 0) | (self.n != 0))
        return used, self.z[used], self.n[used]

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def learn(self, buckets: np.ndarray, values: np.ndarray, label: float) -> None:
        z, n = self.z[buckets], self.n[buckets]
        w = self._weights(z, n)
        gradient = (sigmoid(float(w @ values)) - label) * values
        squares = n + gradient * gradient
        self.z[buckets] = z + gradient - (np.sqrt(squares) - np.sqrt(n)) / self.alpha * w
        self.n[buckets] = squares

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))
