"""Packing token sequences by length patterns and non-negative least squares.

Only the histogram of piece lengths is planned over, and it has as many bins as
a sequence has tokens, whatever the corpus. Patterns of up to four lengths that
fill a sequence exactly are enumerated; non-negative least squares fits how
often each is used to the histogram; the counts are rounded down to what the
histogram holds, and what is left is packed best-fit, largest first, bin by bin
of the histogram. A piece finds its place from its rank among the pieces of its
length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, stored, values
from tarn.llm.tokens import vocabulary

SEQUENCE_TOKENS = 2048
END_ID = 0
# A length's pieces are ranked in so many parts at least, and in parts of so
# many pieces at most on average, so a length that most pieces share does not
# end up in a few tasks, whatever the corpus.
RANK_PARTS = 64
PART_PIECES = 1 << 22

# Exact patterns of three and of four lengths that start from each length.
PATTERNS_PER_LENGTH = 8
# The fit ends when a round takes less than this share off the squared residual,
# or when this share of the histogram's squares is all that is left.
FIT_GAIN = 1e-5
FIT_EXACT = 1e-12

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = SEQUENCE_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``token_ids``).

    A document is its text's ids and an end id. One longer than ``capacity`` is
    cut into full pieces, of which only the first may be shorter.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            rows: list[tuple] = []
            cut: list[np.ndarray] = []
            texts = values(batch.column("text"))
            for owner, content in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(words.ids_with_added(content), np.array([END_ID], "<u4"))
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for n, (s, e) in enumerate(zip(edges, edges[1:])):
                    rows.append((owner, n, s, e - s, zlib.crc32(ids[s:e].tobytes())))
                    if with_ids:
                        cut.append(ids[s:e])
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                ends = np.cumsum([0, *map(len, cut)])
                flat = np.concatenate(cut) if cut else np.array([], "<u4")
                arrays.append(
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))
                    )
                )
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), body("text").alias("text")
    )
    return rows.mapInArrow(encode, PIECE_SCHEMA + (", token_ids array<int>" if with_ids else ""))


def exact_patterns(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Multisets of one to four present lengths that sum to ``capacity``.

    One row each, zeros where a pattern is shorter. All pairs are there; triples
    and quadruples are picked evenly, a bounded number per length.
    """
    there = np.flatnonzero(histogram[: capacity + 1])
    there = there[there > 0]
    found = []
    if len(there) and there[-1] == capacity:
        found.append(np.array([[capacity, 0, 0, 0]]))
    rest = capacity - there
    two = there[(rest > 0) & (rest <= there)]
    if len(two):
        two = two[histogram[capacity - two] > 0]
        found.append(np.stack([two, capacity - two, 0 * two, 0 * two], axis=1))
    if len(there):
        a = np.repeat(there, PATTERNS_PER_LENGTH)
        n = np.arange(len(a))
        golden = (np.sqrt(5) - 1) / 2
        b = there[((n * golden) % 1 * len(there)).astype(int)]
        third = capacity - a - b
        good = (third > 0) & (histogram[np.clip(third, 0, capacity)] > 0)
        found.append(np.stack([a, b, third, 0 * a], axis=1)[good])
        c = there[((n * golden * golden) % 1 * len(there)).astype(int)]
        fourth = capacity - a - b - c
        good = (fourth > 0) & (histogram[np.clip(fourth, 0, capacity)] > 0)
        found.append(np.stack([a, b, c, fourth], axis=1)[good])
    if not found:
        return np.zeros((0, 4), int)
    return np.unique(np.sort(np.concatenate(found), axis=1)[:, ::-1], axis=0)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares of pattern uses against the histogram.

    Multiplicative updates: each use is scaled by how much its lengths are
    wanted over how much they are used, so none turns negative and the residual
    never grows. They go on until the residual stands still.
    """
    if not len(patterns):
        return np.zeros(0)
    wanted = histogram.astype(float)
    filled = patterns > 0
    columns = np.where(filled, patterns, 0)
    wanted[0] = 0

    def back(values: np.ndarray) -> np.ndarray:
        return np.where(filled, values[columns], 0).sum(axis=1)

    share = back(wanted)
    uses = np.maximum(share / share.sum() * wanted.sum() / filled.sum(axis=1).mean(), 1e-9)
    before, exact = np.inf, FIT_EXACT * (wanted**2).sum()
    while True:
        made = np.bincount(
            columns.ravel(), weights=np.repeat(uses, 4), minlength=len(wanted)
        )
        made[0] = 0
        residual = ((made - wanted) ** 2).sum()
        if residual <= exact or residual > (1 - FIT_GAIN) * before:
            return uses
        before = residual
        uses *= share / np.maximum(back(made), 1e-12)


def plan_sequences(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a sequence, number of such sequences)`` for the whole histogram."""
    left = histogram.copy()
    left[0] = 0
    patterns = exact_patterns(left, capacity)
    uses = fit_counts(patterns, left)
    plan: list[tuple[tuple[int, ...], int]] = []
    for n in np.argsort(-uses, kind="stable").tolist():
        times = int(uses[n])
        if not times:
            break
        lengths, multiple = np.unique(patterns[n][patterns[n] > 0], return_counts=True)
        times = min(times, int((left[lengths] // multiple).min()))
        if times:
            left[lengths] -= times * multiple
            plan.append((tuple(patterns[n][patterns[n] > 0].tolist()), times))
    return plan + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: equal sequences are filled together."""
    groups: dict[int, list[list]] = {}  # room left -> [lengths, sequences]
    rooms = np.zeros(capacity + 1, bool)

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        groups.setdefault(room, []).append([lengths, times])
        rooms[room] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            fitting = np.flatnonzero(rooms[length:])
            if not len(fitting):
                each = capacity // length
                whole, more = divmod(count, each)
                if whole:
                    put(capacity - each * length, (length,) * each, whole)
                if more:
                    put(capacity - more * length, (length,) * more, 1)
                break
            room = length + int(fitting[0])
            lengths, times = groups[room][-1]
            taken = min(times, count)
            if taken == times:
                groups[room].pop()
                rooms[room] = bool(groups[room])
            else:
                groups[room][-1][1] -= taken
            count -= taken
            put(room - length, (*lengths, length), taken)
    return [(tuple(lengths), times) for g in groups.values() for lengths, times in g]


def _places(
    plan: list[tuple[tuple[int, ...], int]], firsts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of ranks: the first rank, its sequence, the offset within it.

    ``firsts[l]`` is the rank of the first piece of length ``l`` over all
    pieces ordered by length.
    """
    taken = firsts.copy()
    runs = []
    sequence = 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            runs.append((taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    runs.sort()
    ranks, sequences, offsets = np.array(runs, np.int64).reshape(-1, 3).T
    return ranks, sequences, offsets


def pack_pieces(cut: DataFrame, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; no sequence exceeds ``capacity``.

    ``cut`` needs ``doc_id, piece, start, length, ids_crc32`` and must be a
    stored table, because it is read three times. Its other columns are kept.
    The driver sees one number per length and rank part: ``RANK_PARTS`` for a
    length, and one more for every ``PART_PIECES`` pieces.
    """
    columns = cut.columns
    # A row per length, so no more than ``capacity``.
    lengths = stored(
        cut.groupBy(F.col("length").alias("_length"))
        .agg(F.count("*").alias("_pieces"))
        .withColumn(
            "_parts",
            F.greatest(F.lit(RANK_PARTS), F.ceil(F.col("_pieces") / F.lit(PART_PIECES))),
        )
    )
    histogram = np.zeros(capacity + 1, np.int64)
    parts = np.zeros(capacity + 1, np.int64)
    for row in lengths.collect():
        histogram[row["_length"]] = row["_pieces"]
        parts[row["_length"]] = row["_parts"]
    parted = (
        cut.join(F.broadcast(lengths), F.col("length") == F.col("_length"))
        .withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_parts")))
        .drop("_length", "_pieces", "_parts")
    )
    # The parts of all lengths in a row, by length.
    part_at = np.cumsum(parts) - parts
    counts = np.zeros(parts.sum(), np.int64)
    for row in parted.groupBy("length", "_part").count().collect():
        counts[part_at[row["length"]] + row["_part"]] = row["count"]
    plan = plan_sequences(histogram, capacity)
    firsts = np.cumsum(histogram) - histogram
    part_firsts = np.cumsum(counts) - counts
    places = cut.sparkSession.sparkContext.broadcast(
        (part_at, part_firsts, *_places(plan, firsts))
    )

    ranked = parted.withColumn(
        "_rank",
        F.row_number().over(
            Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
        ),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_at, part_firsts, ranks, sequences, offsets = places.value
        for batch in batches:
            length, part, rank = (
                batch.column(name).to_numpy(zero_copy_only=False)
                for name in ("length", "_part", "_rank")
            )
            rank = part_firsts[part_at[length] + part] + rank - 1
            run = np.searchsorted(ranks, rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in columns],
                    pa.array(sequences[run] + rank - ranks[run]),
                    pa.array(offsets[run]),
                ],
                [*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = SEQUENCE_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    A null text is empty and gives the end id alone. Null and repeated ids are
    carried as they are: a piece is placed by its length, not by its id. An
    empty table gives no rows. Further columns of ``docs`` do not matter.
    ``path`` names the vocabulary file; ``with_ids`` adds the piece's
    ``token_ids``.
    """
    return pack_pieces(stored(pieces(docs, path, doc_id, text, capacity, with_ids)), capacity)
