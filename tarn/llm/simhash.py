"""SimHash fingerprints of word shingles, linked through BK-trees.

Fingerprints within ``RADIUS`` differing bits link, and links chain. To find
the links without comparing everything with everything, a fingerprint is cut
into four blocks of 16 bits: two that differ in at most two bits agree on at
least two blocks. So each fingerprint joins six shards, one for each pair of
blocks, and linked ones share a shard. A shard is held as a BK-tree, whose
children are keyed by their Hamming distance to the parent; a search follows
only the edges within the radius.

A shard's tree meets its queries in the task that the shard is sent to, instead
of being broadcast to all tasks: all shards together grow with the corpus and
have no size bound. One shard has: those above ``MAX_TREE`` are cut again by
two of the four bytes left, after which 16 bits are open and a tree holds at
most 65,536 fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import field
from tarn.llm.common import body, picked, stored, values, without_ids
from tarn.llm.components import connected_components

# The operator's contract.
SHINGLE_WORDS = 3
RADIUS = 2
HASH_SEED = 42

# Fingerprints that one shard's tree holds before the shard is cut again.
MAX_TREE = 2048
# Shingle hashes that are counted at a time.
CHUNK = 1 << 16

BLOCK_PAIRS = list(combinations(range(4), 2))


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a UTF-8 text's shingles; zero if it has no words."""
    # bytes.lower changes A-Z only, and bytes.split cuts at 0x20 and 0x09-0x0D.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(SHINGLE_WORDS, len(words)) - 1
    starts, ends = starts[: len(starts) - span].tolist(), ends[span:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = [
            digest(joined[s:e], HASH_SEED)
            for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    majority = (ones * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter(
            (fingerprint(text) for text in values(batch.column("text"))),
            np.uint64,
            batch.num_rows,
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"]
        )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, print)`` for every row; the 64 bits are stored as a signed long."""
    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), body("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(_fingerprints, "doc_id bigint, print bigint")


class BKTree:
    """Distinct 64-bit values; a node's children are keyed by distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes at most ``radius`` bits from ``value``."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if -radius <= edge - distance <= radius:
                    open_nodes.append(child)
        return found

    def add(self, value: int) -> None:
        number = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while number:
            distance = (self.values[node] ^ value).bit_count()
            child = self.children[node].setdefault(distance, number)
            if child == number:
                break
            node = child


def _shard_links(prints: list[int], ids: list[int]) -> list[tuple[int, int]]:
    """Links that connect what links within a shard: one fewer than its members.

    Each member points to the least id it reaches here, so a group of n similar
    fingerprints gives n - 1 rows and not all its pairs.
    """
    tree, parent = BKTree(), list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(prints):
        for j in tree.within(value, RADIUS):
            a, b = root(i), root(j)
            if a != b:
                low, high = (a, b) if ids[a] < ids[b] else (b, a)
                parent[high] = low
        tree.add(value)
    return [(ids[i], ids[root(i)]) for i in range(len(prints)) if root(i) != i]


def _finer_keys(key: int, prints: np.ndarray) -> np.ndarray:
    """The six finer shard keys of the members of one shard: (members, 6).

    A key has the shard's block pair, then the finer byte pair, then the bits
    of both.
    """
    pair, fixed = int(key) >> 32, int(key) & 0xFFFFFFFF
    open_bytes = []
    for block in sorted(set(range(4)) - set(BLOCK_PAIRS[pair])):
        for byte in (0, 1):
            open_bytes.append((prints >> np.uint64(16 * block + 8 * byte)) & np.uint64(0xFF))
    keys = []
    for n, (a, b) in enumerate(combinations(range(4), 2)):
        head = np.uint64(((pair * 6 + n) << 48) | (fixed << 16))
        keys.append(head | (open_bytes[a] << np.uint64(8)) | open_bytes[b])
    return np.stack(keys, axis=1).view(np.int64)


OUT = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _scan_shards(
    most: int | None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by key to links ``(null, null, a, b)``.

    Members of a shard of more than ``most`` leave as ``(finer key, print, id,
    null)`` instead; no more than ``most`` of them are held at a time.
    """

    def links_of(key: int, prints: np.ndarray, ids: np.ndarray) -> pa.RecordBatch | None:
        links = _shard_links(prints.view(np.uint64).tolist(), ids.tolist())
        if not links:
            return None
        a, b = zip(*links, strict=True)
        none = pa.nulls(len(links), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=OUT
        )

    def finer(key: int, prints: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        keys = _finer_keys(key, prints.view(np.uint64))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys.reshape(-1)),
                pa.array(np.repeat(prints, 6)),
                pa.array(np.repeat(ids, 6)),
                pa.nulls(keys.size, pa.int64()),
            ],
            schema=OUT,
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, split = None, [], False
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            prints = np.concatenate([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held])
            if split:
                yield finer(held_key, prints, ids)
            elif len(prints) > 1 and (out := links_of(held_key, prints, ids)) is not None:
                yield out

        for batch in batches:
            if not batch.num_rows:
                continue
            key, prints, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))
            # Shards of one member that lie inside the batch have no links.
            inner = np.arange(len(starts))
            keep = (ends - starts > 1) | (inner == 0) | (inner == len(starts) - 1)
            for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True):
                if held_key is None or int(key[s]) != held_key:
                    yield from close()
                    held_key, held, split, size = int(key[s]), [], False, 0
                held.append((prints[s:e], ids[s:e]))
                size += e - s
                if most is not None and size > most:
                    split = True
                    yield from close()
                    held = []
        yield from close()

    return scan


def _links(reps: DataFrame) -> DataFrame:
    """``(a, b)``: links that join what lies within the radius, from ``(id, print)``."""
    block = [F.shiftrightunsigned("print", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = [
        F.lit(n << 32).cast("bigint") + F.shiftleft(block[a], 16) + block[b]
        for n, (a, b) in enumerate(BLOCK_PAIRS)
    ]
    schema = "key bigint, print bigint, a bigint, b bigint"

    def scanned(rows: DataFrame, most: int | None) -> DataFrame:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        return stored(dealt.mapInArrow(_scan_shards(most), schema))

    shards = reps.select(F.explode(F.array(*keys)).alias("key"), "print", "id")
    first = scanned(shards, MAX_TREE)
    finer = first.where("key IS NOT NULL").select("key", "print", F.col("a").alias("id"))
    second = scanned(finer, None)
    return first.where("key IS NULL").select("a", "b").union(second.select("a", "b"))


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into
    shingles of three words, repeats included; a text of one or two words is
    one shingle. A null text is an empty one. Texts without words have the
    fingerprint zero and link like any other.

    ``component_id`` is the least id reachable. A row with a null id takes the
    component of its fingerprint (null if all its rows have null ids) and gives
    none. Rows that repeat an id count once. An empty table gives no rows, and
    further columns of ``docs`` do not matter.
    """
    prints = stored(fingerprints(docs, doc_id, text))
    reps = stored(prints.groupBy("print").agg(F.min("doc_id").alias("id")))
    linked = connected_components(_links(reps.where("id IS NOT NULL").select("print", "id")))
    classes = reps.join(linked, reps["id"] == linked["node"], "left").select(
        F.col("print").alias("class_print"), F.coalesce("component", "id").alias("component_id")
    )
    return prints.join(classes, prints["print"] == classes["class_print"], "left").select(
        F.col("doc_id").alias(doc_id),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the least id of their component, all columns kept.

    Rows with a null id stay: nothing tells which row of a group they are.
    """
    groups = simhash_groups(docs, doc_id, text)
    gone = groups.where(field(doc_id) != F.col("component_id")).select(field(doc_id))
    return without_ids(docs, doc_id, gone)
