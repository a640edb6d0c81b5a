"""Secret scanning with multipart credential linking.

Strong patterns are reported wherever they occur. Weak ones (a random-looking
string, a user name, a short key id) mean little alone: they are reported only
when a complementary part lies in the same scope, a stretch of one paragraph.
A secret's complements are identifiers and endpoints, an identifier's are
secrets.

Parts are found text by text and linked as intervals in Spark: within a
paragraph, ordered by start, the nearest part of each role on either side
decides, so no pairs are enumerated.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, stored, values
from tarn.llm.spans import SPANS_TYPE, no_spans

# Kinds in the order of ties. The first three are the base.
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "linked_id", "linked_secret"]

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]{24,}")

# Parts that count only together.
ENDPOINT = re.compile(
    r"""\b(?:https?|ftps?|s3|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|jdbc:[a-z]+)"""
    r"""://[^\s"'<>]+"""
    r"""|\b(?:host(?:name)?|endpoint|server|url|uri)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]+""",
    re.IGNORECASE | re.ASCII,
)
IDENTIFIER = re.compile(
    r"""\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|key_?id)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]+|\b(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{12,}\b""",
    re.IGNORECASE | re.ASCII,
)
# What every bare identifier begins with, in lower case.
KEY_PREFIXES = ("akia", "asia", "aroa", "aida")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}", re.ASCII)
LEAST_LENGTH = 16
# Between words that make up a name or a path.
BREAKS = re.compile("[-_/+=]")
# Bits per character below which a string doesn't look random: one with digits,
# and one of letters alone.
LEAST_ENTROPY = 3.0
LETTERS_ENTROPY = 3.75
# Code points between two parts of one credential, at most.
SCOPE = 200
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")

SCAN_SCHEMA = (
    f"row_key bigint, doc_id bigint, base {SPANS_TYPE}, "
    "parts array<struct<paragraph:bigint,start:bigint,end:bigint,role:string,weak:boolean>>"
)


def entropy(candidate: str) -> float:
    """Bits per character, by the characters' own shares."""
    size = len(candidate)
    shares = (n / size for n in Counter(candidate).values())
    return -sum(p * math.log2(p) for p in shares)


def looks_random(candidate: str) -> bool:
    """Whether length and entropy are those of a key rather than of words.

    Digits among letters are no words, and UUIDs, hexadecimal and base32 keys
    are random at fewer bits than letters alone, of which a run without breaks
    must be as mixed as no word is.
    """
    if any(c.isdigit() for c in candidate):
        return any(c.isalpha() for c in candidate) and entropy(candidate) >= LEAST_ENTROPY
    longest = max(BREAKS.split(candidate), key=len)
    return len(longest) >= LEAST_LENGTH and entropy(longest) >= LETTERS_ENTROPY


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """Matches of the base patterns as (start, rank, kind, end), kind by kind."""
    found = []
    if "=" in text or ":" in text:
        found += [
            (m.start(), 0, "assign", m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_VALUE
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, "access", m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return found


class Covered:
    """The stretches that spans cover, to be asked which places they meet."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        last = bisect_left(self.starts, end) - 1
        return last >= 0 and self.ends[last] > start


def credential_parts(
    text: str, base: list[tuple[int, int, str, int]]
) -> list[tuple[int, int, int, str, bool]]:
    """(paragraph, start, end, role, weak) of a text's identifiers, secrets and endpoints.

    Empty if no weak part can find a complement. Weak parts don't overlap base
    spans.
    """
    parts = [(s, e, "id" if kind == "access" else "secret", False) for s, _, kind, e in base]
    taken = Covered((s, e) for s, e, _, _ in parts)
    named = "=" in text or ":" in text
    lower = "" if named else text.lower()
    if named:
        parts += [(m.start(), m.end(), "endpoint", False) for m in ENDPOINT.finditer(text)]
    if named or any(prefix in lower for prefix in KEY_PREFIXES):
        parts += [
            (m.start(), m.end(), "id", True)
            for m in IDENTIFIER.finditer(text)
            if not taken.meets(m.start(), m.end())
        ]
    if any(role != "secret" for _, _, role, _ in parts):
        spots = Covered((s, e) for s, e, role, _ in parts if role != "secret")
        for m in RANDOM.finditer(text):
            start, end = m.span()
            if spots.meets(start, end) or taken.meets(start, end):
                continue
            if looks_random(m.group()):
                parts.append((m.start(), m.end(), "secret", True))
    if not any(weak for *_, weak in parts):
        return []
    parts.sort()
    breaks = [m.end() for m in PARAGRAPH.finditer(text)]
    placed, number = [], 0
    for start, end, role, weak in parts:
        while number < len(breaks) and breaks[number] <= start:
            number += 1
        placed.append((number, start, end, role, weak))
    return placed


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = TaskContext.get().partitionId() << 40
    spans = pa.list_(
        pa.struct(
            [
                ("start", pa.int64()), ("rank", pa.int32()),
                ("kind", pa.string()), ("end", pa.int64()),
            ]
        )
    )
    parts = pa.list_(
        pa.struct(
            [
                ("paragraph", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                ("role", pa.string()), ("weak", pa.bool_()),
            ]
        )
    )
    names = {kind: [f.name for f in kind.value_type] for kind in (spans, parts)}

    def structs(rows: list[list[tuple]], kind: pa.ListType) -> pa.Array:
        return pa.array(
            [[dict(zip(names[kind], row, strict=True)) for row in found] for found in rows], kind
        )

    for batch in batches:
        base, linked = [], []
        for text in values(batch.column("text")):
            base.append(base_spans(text))
            linked.append(credential_parts(text, base[-1]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(key, key + len(base)), pa.int64()),
                batch.column("doc_id"),
                structs(base, spans),
                structs(linked, parts),
            ],
            ["row_key", "doc_id", "base", "parts"],
        )
        key += len(base)


def _near(role: str, before: Window, after: Window) -> Column:
    """Whether a part of ``role`` lies within the scope, on either side."""
    last_end = F.max(F.when(F.col("role") == role, F.col("end"))).over(before)
    next_start = F.min(F.when(F.col("role") == role, F.col("start"))).over(after)
    return F.coalesce(F.col("start") - last_end <= SCOPE, F.lit(False)) | F.coalesce(
        next_start - F.col("end") <= SCOPE, F.lit(False)
    )


def _linked(scanned: DataFrame) -> DataFrame:
    """``(linked_key, linked)``: weak parts with a complement in scope, per row."""
    parts = scanned.where(F.size("parts") > 0).select("row_key", F.inline("parts"))
    # What follows is what precedes in the other order: Spark goes through a frame
    # that begins with the partition once, and through one that ends with it for
    # every row.
    paragraph, order = Window.partitionBy("row_key", "paragraph"), ["start", "end", "role", "weak"]
    passed = (Window.unboundedPreceding, -1)
    before = paragraph.orderBy(*order).rowsBetween(*passed)
    after = paragraph.orderBy(*[F.desc(name) for name in order]).rowsBetween(*passed)
    near = {role: _near(role, before, after) for role in ("id", "secret", "endpoint")}
    is_id = F.col("role") == "id"
    complete = F.when(is_id, near["secret"]).otherwise(near["id"] | near["endpoint"])
    kind = F.when(is_id, F.lit("linked_id")).otherwise(F.lit("linked_secret"))
    rank = F.when(is_id, F.lit(KINDS.index("linked_id"))).otherwise(
        F.lit(KINDS.index("linked_secret"))
    )
    span = F.struct("start", rank.alias("rank"), kind.alias("kind"), "end")
    return (
        parts.withColumn("complete", complete)
        .where("weak AND complete")
        .groupBy(F.col("row_key").alias("linked_key"))
        .agg(F.collect_list(span).cast(SPANS_TYPE).alias("linked"))
    )


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``found``, the spans by start.

    A span has ``start``, ``rank``, ``kind`` and ``end``, in code points, end
    exclusive. Null texts are empty and have no spans; null and repeated ids are
    carried as they are. An empty table gives no rows; further columns do not
    matter.
    """
    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), body("text").alias("text")
    )
    scanned = stored(rows.mapInArrow(_scan, SCAN_SCHEMA))
    linked = _linked(scanned)
    joined = scanned.join(linked, scanned["row_key"] == linked["linked_key"], "left")
    found = F.array_sort(F.concat("base", F.coalesce("linked", no_spans())))
    return joined.select(F.col("doc_id").alias(doc_id), found.alias("found"))

