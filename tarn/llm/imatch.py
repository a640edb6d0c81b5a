"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon keeps the terms whose document frequency lies in a band, given as
shares of the documents. A text's distinct lexicon terms are sorted and hashed
once for the whole lexicon and once for each of several random subsets, drawn
at halving rates so that texts of any length have subsets in which they keep a
term or two. An edit changes the hashes of the subsets that hold a changed
term; the share of the others tells how alike two texts are.

A document has a bounded number of terms on average, A, so at most A / ``LOW``
terms can reach the share ``LOW``: the lexicon that is broadcast does not grow
with the number of documents.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, stored, values

# The band: shares of the documents that hold a term.
LOW = 0.0004
HIGH = 0.2
# Random subsets per rate, and rates: 1/2, 1/4, ...
COPIES = 16
LEVELS = 10
# A level says something of two texts if they have terms in so many subsets.
LEAST_SUBSETS = 8
COPY_SEEDS = np.array([xxhash.xxh3_64_intdigest(str(copy)) for copy in range(COPIES)], np.uint64)
# How many of the rarest levels a subset takes, for each rate.
RANKS = LEVELS - 1 - np.arange(LEVELS)
NO_PLACES = np.zeros(0, np.int64)
# Where a copy's counts begin, of a number for each rank.
COPY_CELLS = np.arange(COPIES) * (LEVELS + 1)

# Distinct terms that a task counts before it sends its counts on, and words a
# worker remembers.
HELD_TERMS = 400_000
# Ranges of the corpus in id order: per shuffle partition, so that their loads
# even out, and per million documents at least. The driver plans so many at most;
# a range is read as a stream, so beyond them ranges grow.
RANGES_PER_PARTITION = 4
RANGES_PER_MILLION = 160
MOST_RANGES = 20_000

WORDS = re.compile(r"\w+")


def term_hash(word: str) -> int:
    """A term's 64-bit hash, as a signed long."""
    value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
    return value - (1 << 64) if value >> 63 else value


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, combined over a task before they leave it."""
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        hashes = [term_hash(word) for word in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes, pa.int64()), pa.array(list(counts.values()), pa.int64())],
            ["term", "documents"],
        )

    for batch in batches:
        for text in values(batch.column("text")):
            counts.update(set(WORDS.findall(text.lower())))
            if len(counts) >= HELD_TERMS:
                yield out()
                counts.clear()
    if counts:
        yield out()


def lexicon(
    docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH
) -> np.ndarray:
    """Sorted hashes of the terms held by ``low`` to ``high`` of the documents.

    All documents count; a term that only one holds is never in the lexicon.
    """
    texts = picked(docs, text=text).select(body("text").alias("text"))
    total = texts.count()
    counted = texts.mapInArrow(_count_terms, "term bigint, documents bigint")
    kept = (
        counted.groupBy("term")
        .agg(F.sum("documents").alias("documents"))
        .where(F.col("documents").between(max(2.0, low * total), max(2.0, high * total)))
        .select("term")
    )
    return np.sort(kept.toArrow().column("term").to_numpy())


class Known(dict):
    """Maps a word to its place in the lexicon, or -1; remembers the first it meets."""

    def __init__(self, terms: np.ndarray):
        super().__init__()
        self.places = {term: place for place, term in enumerate(terms.tolist())}

    def __missing__(self, word: str) -> int:
        found = self.places.get(term_hash(word), -1)
        if len(self) < HELD_TERMS:
            self[word] = found
        return found


@dataclass(frozen=True)
class Read:
    """A text's words: those before the last word that reaches into the part an
    edit keeps, with their places in the lexicon, and the lowered rest."""

    text: str
    head: frozenset[str]
    places: np.ndarray
    rest: str
    kept: str

    @property
    def cut(self) -> int:
        return len(self.text) // 4


def _is_word(letter: str) -> bool:
    """Whether ``WORDS`` takes the character."""
    return letter.isalnum() or letter == "_"


def _lowers_alone(text: str) -> bool:
    """Whether each character's lower case is one character, whatever is around it."""
    return "\u0130" not in text and "\u03a3" not in text


class Fingerprints:
    """Fingerprints of texts under one lexicon: 16-bit hashes of the whole lexicon
    and of every subset.

    A subset in which the text has no term gives zero. A text with no term in
    the lexicon is hashed by all its terms.
    """

    def __init__(self, terms: np.ndarray):
        self.known = Known(terms)
        self.terms = terms.view(np.uint64)
        self.ranks = _ranks(self.terms)

    def read(self, text: str) -> Read:
        """The words that the text and its edited form share are looked up once."""
        if not _lowers_alone(text):
            return Read(text, frozenset(), NO_PLACES, text.lower(), "")
        low = text.lower()
        keep = len(text) - len(text) // 4
        start = keep
        while start and _is_word(low[start - 1]):
            start -= 1
        head = frozenset(WORDS.findall(low[:start]))
        return Read(text, head, self._places(head), low[start:], low[start:keep])

    def _places(self, words: Set[str]) -> np.ndarray:
        places = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return places[places >= 0]

    def of(self, text: str) -> str:
        """The fingerprint of a text, four hex digits for each hash."""
        return printed(self.hashes(self.read(text)))

    def hashes(self, read: Read) -> np.ndarray:
        return self._of(read.head, read.places, read.rest)

    def edit_hashes(self, read: Read, following: str, edited: str) -> np.ndarray:
        """Of ``edited``: what an edit keeps of the text, then ``following``."""
        if _lowers_alone(read.text) and _lowers_alone(following):
            return self._of(read.head, read.places, read.kept + following.lower())
        return self._of(frozenset(), NO_PLACES, edited.lower())

    def _of(self, head: Set[str], places: np.ndarray, rest: str) -> np.ndarray:
        others = set(WORDS.findall(rest)) - head
        at = np.sort(np.concatenate((places, self._places(others))))
        if len(at):
            return _print(self.terms[at], self.ranks[at])
        hashes = [term_hash(word) for word in (*head, *others)]
        terms = np.sort(np.array(hashes, np.int64)).view(np.uint64)
        return _print(terms, _ranks(terms))


def _ranks(terms: np.ndarray) -> np.ndarray:
    """How common the subsets are that hold a term, for each copy: (terms, copies).

    A term is in a copy's subset of rate 1 / 2**n if n low bits are zero.
    """
    mixed = _mix(terms[:, None] ^ COPY_SEEDS[None, :])
    zeros = np.bitwise_count((mixed & -mixed) - np.uint64(1))
    return (LEVELS - np.minimum(zeros, LEVELS)).astype(np.uint8)


def _print(terms: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The hashes of sorted ``terms``: the whole, then copy by copy and rate by rate."""
    # Rarest first and then by hash: each subset is a run from the start.
    by_copy = np.ascontiguousarray(ranks.T)
    ordered = terms[np.argsort(by_copy, axis=1, kind="stable")]
    cells = by_copy + COPY_CELLS[:, None]
    counts = np.bincount(cells.ravel(), minlength=COPIES * (LEVELS + 1))
    sizes = counts.reshape(COPIES, LEVELS + 1).cumsum(axis=1)[:, RANKS]
    digest = xxhash.xxh3_64_intdigest
    found = [digest(terms.tobytes()) % 0xFFFF + 1 if len(terms) else 0]
    for row, ends in zip(ordered, (8 * sizes).tolist(), strict=True):
        held = row.tobytes()
        found += [digest(held[:end]) % 0xFFFF + 1 if end else 0 for end in ends]
    return np.array(found, np.uint16)


def printed(hashes: np.ndarray) -> str:
    """Four hex digits for each hash."""
    return hashes.astype(">u2").tobytes().hex()


def _mix(values: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash: spreads its bits over one another."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def likeness(one: str, other: str) -> float:
    """0 to 1: the largest share, over the rates, of subsets that agree.

    Subsets empty on both sides don't count, and a rate counts if enough are
    not. Equal fingerprints give 1.
    """
    return _likeness(*(np.frombuffer(bytes.fromhex(text), ">u2") for text in (one, other)))


def _likeness(one: np.ndarray, other: np.ndarray) -> float:
    same = one == other
    if same.all():
        return 1.0
    held = ((one != 0) | (other != 0))[1:].reshape(COPIES, LEVELS)
    counts = held.sum(axis=0)
    agreeing = (held & same[1:].reshape(COPIES, LEVELS)).sum(axis=0)
    enough = counts >= LEAST_SUBSETS
    return float((agreeing[enough] / counts[enough]).max(initial=0.0))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` for every row of ``docs``; a null text is empty."""
    terms = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(terms.value)
        for batch in batches:
            found = [prints.of(content) for content in values(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"]
            )

    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), body("text").alias("text")
    )
    return rows.mapInArrow(apply, "doc_id bigint, fingerprint string")


def _cuts_below(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are less than ``key``, searched in two steps."""
    step = isqrt(len(cuts)) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)] or [[]]

    def less(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c < key))

    def numbers(values: list[int]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")

    passed = less(numbers([group[0] for group in groups if group]))
    group = F.get(F.array(*map(numbers, groups)), passed - 1)
    return F.when(passed == 0, 0).otherwise((passed - 1) * step + less(group)).cast("int")


def _in_id_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Ranges of documents in id order, each followed by the next one's first.

    ``(bucket, place, doc_id, text)``, where ``place`` 1 marks the follower;
    the last range is followed by the first document of all. Every text is
    shuffled once. Null ids come first; rows with the same id are ordered by
    their texts' hashes.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    rows = (
        picked(docs, doc_id=doc_id, text=text)
        .select(
            key.alias("id_key"), F.col("doc_id").cast("bigint"), body("text").alias("text")
        )
        .withColumn("tie", F.xxhash64("text"))
    )
    ids = picked(docs, doc_id=doc_id).select(key.alias("id_key"))
    total = ids.count()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(partitions * RANGES_PER_PARTITION, total * RANGES_PER_MILLION // 1_000_000)
    ranges = min(wanted, MOST_RANGES)
    shares = [n / ranges for n in range(1, ranges)]
    found = ids.agg(F.percentile_approx("id_key", shares, 20 * ranges)).first()[0]
    cuts = sorted(set(found or []))
    bucket = _cuts_below(F.col("id_key"), cuts)
    heads = stored(
        rows.select(bucket.alias("bucket"), "id_key", "tie")
        .groupBy("bucket")
        .agg(F.min(F.struct("id_key", "tie")).alias("head"))
    )
    # As many rows as there are ranges: whose first document follows which.
    order = [row.bucket for row in heads.orderBy("bucket").select("bucket").collect()]
    before = {b: order[n - 1] for n, b in enumerate(order)}
    previous = docs.sparkSession.createDataFrame(
        list(before.items()) or [(0, 0)], "bucket int, previous int"
    )
    led = heads.join(F.broadcast(previous), "bucket").select(
        F.col("bucket").alias("h_bucket"), "head", "previous"
    )
    placed = rows.withColumn("bucket", bucket).join(
        F.broadcast(led), F.col("bucket") == F.col("h_bucket")
    )
    is_head = F.struct("id_key", "tie") == F.col("head")
    spots = F.array_compact(
        F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("place")),
            F.when(is_head, F.struct(F.col("previous").alias("bucket"), F.lit(1).alias("place"))),
        )
    )
    dealt = placed.select(F.explode(spots).alias("spot"), "id_key", "tie", "doc_id", "text")
    return (
        dealt.select("spot.bucket", "spot.place", "id_key", "tie", "doc_id", "text")
        .repartition(max(1, len(order) // RANGES_PER_PARTITION), "bucket")
        .sortWithinPartitions("bucket", "place", "id_key", "tie")
        .select("bucket", "place", "doc_id", "text")
    )


EDIT_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edit_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The edited form replaces the last quarter of the code points by the first
    as many (or all) of the next document's, in ascending order of ids; the
    first document follows the last. A null text is empty, null ids come first,
    and one document alone follows itself. An empty table gives no rows;
    further columns do not matter.
    """
    terms = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(terms.value)
        names = [part.split()[0] for part in EDIT_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        held = None
        for batch in batches:
            rows = []
            for bucket, place, owner, content in zip(
                *(values(batch.column(i)) for i in range(4)), strict=True
            ):
                read = prints.read(content)
                own = prints.hashes(read)
                if held is not None and held[0] == bucket:
                    _, last_owner, last, last_print = held
                    following = content[: last.cut]
                    edited = last.text[: len(last.text) - last.cut] + following
                    edited_print = (
                        prints.edit_hashes(last, following, edited) if last.cut else last_print
                    )
                    rows.append(
                        (
                            last_owner,
                            len(last.text),
                            hashlib.sha256(edited.encode()).hexdigest(),
                            printed(last_print),
                            printed(edited_print),
                            _likeness(last_print, edited_print),
                            _likeness(last_print, own),
                        )
                    )
                # A range's follower is its last row and has no row of its own.
                held = None if place else (bucket, owner, read, own)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return _in_id_order(docs, doc_id, text).mapInArrow(compare, EDIT_SCHEMA)
