"""Near duplicates by a chosen-path similarity join of shingle sets.

Equal sets are one class, and a class is joined by its signature of minwise
tokens. A tree starts with all classes in its root; a node picks one of the
signature's places, now and then two, 1 / 0.8 on average, and a class goes down
to the children that its tokens there name. Two sets of similarity 0.8 part at
a node with a chance of 0.16, so ``TREES`` independent trees leave one pair in
10**7 apart at the first level and one in 10**4 three levels down.

A small node compares all its members, by signature, and reports which are
connected, one edge fewer than members. A large node compares its members with
one of them, the pivot. Those that resemble it leave the node: what is linked to
them must itself be within twice the distance of the pivot, and everything that
near is connected to the pivot here. The others go down the tree.

What signatures connect are candidates. Each group of connected classes is then
compared exactly, by the full sets of its texts, the likeliest pairs first, and
pairs that are linked through others already are passed over. Texts reach that
step once; a group too large for one task is cut into blocks, and each pair of
blocks is a task's work, so no size of group is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, filter_pages, flag_members, picked, stored, values
from tarn.llm.components import connected_components

# The operator's contract: words of a shingle, and the least similarity of a link.
SHINGLE_WORDS = 4
LEAST_PERCENT = 80

# Places of a signature and independent trees.
PLACES = 128
TREES = 10
# A node picks a second place with this chance: 1 / 0.8 places on average.
SECOND_PLACE = 0.25
# Members of a node that are all compared with each other.
SMALL = 512
# Equal places that make two classes candidates: of links (102 of 128 expected)
# one in 3,000 has fewer. Members that share as few as WIDE with a large node's
# pivot, which is what a link to a candidate of the pivot shares at least, are
# connected to it too.
CANDIDATE = 86
WIDE = 46
# Classes and shingles that one task compares exactly.
TASK_CLASSES = 4096
TASK_SHINGLES = 2_000_000
# Shingles whose minwise tokens are computed at a time.
CHUNK = 4096

SEEDS = np.array([xxhash.xxh3_64_intdigest(f"place {i}") for i in range(PLACES)], np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes) -> np.ndarray:
    """The distinct hashes of a UTF-8 text's shingles, sorted; none without words."""
    # bytes.lower changes A-Z only, and bytes.split cuts at 0x20 and 0x09-0x0D.
    words = text.lower().split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)) if words else ends
    span = min(SHINGLE_WORDS, len(words)) - 1
    starts, ends = starts[: len(starts) - span], ends[max(span, 0) :]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.unique(np.array(hashes, np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least token of each place, as 32-bit numbers."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        mixed = (hashes[at : at + CHUNK, None] ^ SEEDS) * ODD
        mixed ^= mixed >> np.uint64(29)
        least = np.minimum(least, (mixed * ODD).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


SET_SCHEMA = (
    "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, signature binary"
)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, keys, signatures = [], [], []
        for text in values(batch.column("text")):
            hashes = shingles(text)
            counts.append(len(hashes))
            keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
            signatures.append(signature(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(counts, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            [part.split()[0] for part in SET_SCHEMA.split(", ")],
        )


def _child(path: int, place: int, token: int) -> int:
    """The node that ``token`` at ``place`` leads to, as a signed long."""
    held = b"%d.%d.%d" % (path, place, token)
    return xxhash.xxh3_64_intdigest(held) - (1 << 63)


def _places(path: int) -> list[int]:
    """The places that a node picks: the same for all its members."""
    draw = xxhash.xxh3_64_intdigest(b"places %d" % path)
    first, second = draw % PLACES, (draw >> 16) % PLACES
    both = (draw >> 32) / (1 << 32) < SECOND_PLACE and first != second
    return [first, second] if both else [first]


MEMBER_SCHEMA = "path bigint, set_key binary"


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first level of every tree."""
    picks = [(tree, place) for tree in range(TREES) for place in _places(tree)]
    for batch in batches:
        paths, keys = [], []
        for key, held in zip(
            batch.column("set_key").to_pylist(), batch.column("signature").to_pylist(), strict=True
        ):
            tokens = np.frombuffer(held, np.uint32).tolist()
            paths += [_child(tree, place, tokens[place]) for tree, place in picks]
            keys += [key] * len(picks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.int64()), pa.array(keys, pa.binary())], ["path", "set_key"]
        )


class Groups:
    """Which of n members are connected."""

    def __init__(self, n: int):
        self.labels = np.arange(n)

    def join(self, a: int, b: int) -> bool:
        one, other = self.labels[a], self.labels[b]
        if one == other:
            return False
        self.labels[self.labels == max(one, other)] = min(one, other)
        return True


EDGE_SCHEMA = "a binary, b binary"


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"]
    )


def _candidates_within(keys: list[bytes], tokens: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Edges that connect what candidates connect, fewer than members."""
    groups, found = Groups(len(keys)), []
    for i in range(len(keys) - 1):
        alike = np.count_nonzero(tokens[i + 1 :] == tokens[i], axis=1) >= CANDIDATE
        for j in (np.flatnonzero(alike) + i + 1).tolist():
            if groups.join(i, j):
                found.append((keys[i], keys[j]))
    return found


def _by_group(
    batches: Iterator[pa.RecordBatch], columns: list[str]
) -> Iterator[tuple[object, list[list]]]:
    """``(group, columns)`` of rows sorted by the column ``group``, one at a time."""
    group, held = None, None
    for batch in batches:
        rows = [batch.column(name).to_pylist() for name in columns]
        for n, key in enumerate(batch.column("group").to_pylist()):
            if held is None or key != group:
                if held is not None:
                    yield group, held
                group, held = key, [[] for _ in columns]
            for column, row in zip(held, rows, strict=True):
                column.append(row[n])
    if held is not None:
        yield group, held


def _compare_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs: list[tuple[bytes, bytes]] = []
    for _, (keys, held) in _by_group(batches, ["set_key", "signature"]):
        tokens = np.frombuffer(b"".join(held), np.uint32).reshape(len(keys), PLACES)
        pairs += _candidates_within(keys, tokens)
        if len(pairs) > 10_000:
            yield _edges(pairs)
            pairs = []
    if pairs:
        yield _edges(pairs)


def _compare_with_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges to the pivot as ``(null, set_key, pivot)``, and what goes down the
    tree as ``(path, set_key, null)``."""
    for batch in batches:
        out = []
        for path, key, held, pivot, pivot_held in zip(
            *(column.to_pylist() for column in batch.columns), strict=True
        ):
            tokens, other = np.frombuffer(held, np.uint32), np.frombuffer(pivot_held, np.uint32)
            alike = np.count_nonzero(tokens == other)
            if alike >= WIDE and key != pivot:
                out.append((None, key, pivot))
            if alike < CANDIDATE:
                out += [(_child(path, p, int(tokens[p])), key, None) for p in _places(path)]
        columns = zip(*out, strict=True) if out else [[], [], []]
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["path", "set_key", "pivot"],
        )


def _candidate_edges(classes: DataFrame, small: int) -> DataFrame:
    """``(a, b)``: edges that connect all candidates, level by level of all trees."""
    signatures = classes.select(F.col("set_key").alias("key"), "signature")
    members = stored(classes.select("set_key", "signature").mapInArrow(_roots, MEMBER_SCHEMA))
    edges = None
    while True:
        sizes = members.groupBy(F.col("path").alias("group")).agg(F.count("*").alias("size"))
        shared = members.join(sizes.where("size > 1"), F.col("path") == F.col("group"))
        held = stored(
            shared.join(signatures, F.col("set_key") == F.col("key")).select(
                "group", "size", "set_key", "signature"
            )
        )
        few = held.where(F.col("size") <= small).select("group", "set_key", "signature")
        ordered = few.repartition("group").sortWithinPartitions("group")
        found = stored(ordered.mapInArrow(_compare_small, EDGE_SCHEMA))
        edges = found if edges is None else edges.union(found)
        many = held.where(F.col("size") > small)
        if many.isEmpty():
            return edges
        drawn = F.struct(F.xxhash64("group", "set_key").alias("draw"), "set_key", "signature")
        pivots = stored(
            many.groupBy(F.col("group").alias("of")).agg(F.min(drawn).alias("pivot")).select(
                "of", F.col("pivot.set_key").alias("pivot"), F.col("pivot.signature").alias("its")
            )
        )
        beside = many.join(pivots, F.col("group") == F.col("of"))
        compared = stored(
            beside.select("group", "set_key", "signature", "pivot", "its").mapInArrow(
                _compare_with_pivot, MEMBER_SCHEMA + ", pivot binary"
            )
        )
        edges = edges.union(
            compared.where("pivot IS NOT NULL").select(
                F.col("set_key").alias("a"), F.col("pivot").alias("b")
            )
        )
        members = compared.where("pivot IS NULL").select("path", "set_key").distinct()


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sets of sorted hashes are as similar as a link asks."""
    small, large = sorted((len(one), len(other)))
    if 100 * small < LEAST_PERCENT * large:
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= LEAST_PERCENT * (small + large - both)


def exact_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what links connect, fewer than there are sets.

    Pairs come by the likeness of their signatures, the most alike first; those
    connected already are passed over, so a group of near copies costs about
    one comparison each.
    """
    tokens = np.array([signature(s) for s in sets], np.uint32)
    alike: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for i in range(len(sets) - 1):
        equal = np.count_nonzero(tokens[i + 1 :] == tokens[i], axis=1)
        near = np.flatnonzero(equal >= CANDIDATE)
        if len(near):
            alike.setdefault(i, []).append((equal[near], (near + i + 1).astype(np.int32)))
    if not alike:
        return []
    first = np.concatenate([np.full(len(part[0][0]), i, np.int32) for i, part in alike.items()])
    score = np.concatenate([part[0][0] for part in alike.values()]).astype(np.int16)
    second = np.concatenate([part[0][1] for part in alike.values()])
    groups, found = Groups(len(sets)), []
    for level in range(PLACES, CANDIDATE - 1, -1):
        at = score == level
        a, b = first[at], second[at]
        # One member at a time; what its links connect is passed over at once.
        while len(a):
            apart = groups.labels[a] != groups.labels[b]
            a, b = a[apart], b[apart]
            if not len(a):
                break
            batch = min(len(a), 64)
            for i, j in zip(a[:batch].tolist(), b[:batch].tolist(), strict=True):
                if groups.labels[i] != groups.labels[j] and linked(sets[i], sets[j]):
                    groups.join(i, j)
                    found.append((i, j))
            a, b = a[batch:], b[batch:]
    return found


def _compare_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links within each unit of rows sorted by ``group``."""
    unit, keys, sets = None, [], []

    def out() -> Iterator[pa.RecordBatch]:
        pairs = [(keys[i], keys[j]) for i, j in exact_links(sets)]
        if pairs:
            yield _edges(pairs)

    for batch in batches:
        for group, key, text in zip(
            *(values(batch.column(name)) for name in ("group", "set_key", "text")), strict=True
        ):
            if group != unit:
                yield from out()
                unit, keys, sets = group, [], []
            keys.append(key)
            sets.append(shingles(text))
    yield from out()


def _units(groups: DataFrame, classes: DataFrame, most: int, most_shingles: int) -> DataFrame:
    """``(group, set_key)``: the classes that one task compares, group by group.

    A group too large is dealt into blocks, and every pair of blocks is a unit.
    """
    sized = stored(
        groups.join(classes, F.col("node") == F.col("set_key")).select(
            "component", "set_key", "n_shingles"
        )
    )
    parts = F.ceil(
        F.greatest(2 * F.col("n") / F.lit(most), 2 * F.col("s") / F.lit(most_shingles))
    ).cast("int")
    blocks = (
        sized.groupBy(F.col("component").alias("whole"))
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
        .select("whole", F.when(parts > 2, parts).otherwise(F.lit(1)).alias("blocks"))
    )
    block = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    others = F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: (F.col("blocks") == 1) | (j != F.col("block")),
    )
    return (
        sized.join(blocks, F.col("component") == F.col("whole"))
        .withColumn("block", block)
        .withColumn("other", F.explode(others))
        .select(
            F.struct(
                "component", F.least("block", "other").alias("i"),
                F.greatest("block", "other").alias("j"),
            ).alias("unit"),
            "set_key",
        )
        .select(F.sha2(F.concat_ws(":", F.hex("unit.component"), "unit.i", "unit.j"), 256).alias("group"), "set_key")
    )


def _verified(
    docs: DataFrame, classes: DataFrame, edges: DataFrame, most: int, most_shingles: int
) -> DataFrame:
    """``(a, b)``: links by the full sets, enough to connect all that are linked."""
    groups = connected_components(edges)
    units = stored(_units(groups, classes, most, most_shingles))
    wanted = stored(
        units.select("set_key").distinct().withColumnRenamed("set_key", "w_key").join(
            classes, F.col("w_key") == F.col("set_key")
        ).select("w_key", F.col("id_key").alias("w_id"), F.col("text_key").alias("w_text"))
    )
    keys = [F.col("id_key"), F.col("text_key")]
    flagged = flag_members(docs, keys, filter_pages(wanted.select("w_id", "w_text")), "wanted")
    texts = flagged.where("wanted").select("id_key", "text_key", "text")
    once = texts.dropDuplicates(["id_key", "text_key"])
    found = wanted.join(
        once, (F.col("id_key") == F.col("w_id")) & (F.col("text_key") == F.col("w_text"))
    )
    rows = units.join(found, F.col("set_key") == F.col("w_key")).select("group", "set_key", "text")
    ordered = rows.repartition("group").sortWithinPartitions("group", "set_key")
    return stored(ordered.mapInArrow(_compare_texts, EDGE_SCHEMA))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    small: int = SMALL,
    task_classes: int = TASK_CLASSES,
    task_shingles: int = TASK_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Texts are lower-cased (A-Z), cut into words at ASCII white space, and into
    shingles of four words; a text of fewer words is one shingle. Rows whose sets
    of shingles have a similarity of 0.8 or more are linked; ``component_id`` is
    the least id that links reach, the row's own included, and ``kept`` says
    that it is the row's own. A text without words, or null, has no shingles and
    is linked with nothing.

    A row without an id takes the least id of its component and gives none; it
    is kept where its component has no id. Rows that repeat an id are linked by
    their texts like others. An empty table gives no rows, and further columns
    do not matter.
    """
    texts = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("id_key"),
        F.xxhash64(body("text")).alias("text_key"),
        body("text").cast("binary").alias("text"),
    )
    sets = stored(texts.select("doc_id", "text_key", "text").mapInArrow(_sets, SET_SCHEMA))
    id_key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id_key")
    classes = stored(
        sets.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min("n_shingles").alias("n_shingles"),
            F.min(F.struct(id_key, "text_key", "signature")).alias("one"),
        )
        .select("set_key", "least_id", "n_shingles", "one.*")
    )
    edges = _candidate_edges(classes, small)
    links = _verified(texts, classes, edges, task_classes, task_shingles)
    joined = classes.select("set_key", "least_id").join(
        connected_components(links), F.col("set_key") == F.col("node"), "left"
    )
    labelled = stored(joined.withColumn("component", F.coalesce("component", "set_key")))
    least = labelled.where("node IS NOT NULL").groupBy(F.col("component").alias("of")).agg(
        F.min("least_id").alias("reached")
    )
    ids = stored(
        labelled.join(least, F.col("component") == F.col("of"), "left").select(
            F.col("set_key").alias("class_key"), F.coalesce("reached", "least_id").alias("reached")
        )
    )
    found = sets.where("n_shingles > 0").join(ids, F.col("set_key") == F.col("class_key"))
    alone = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("reached"))
    return found.select("doc_id", "n_shingles", "reached").union(alone).select(
        F.col("doc_id").alias(doc_id),
        "n_shingles",
        F.col("reached").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("reached")).alias("kept"),
    )
