"""Places and prefixes of the turns of conversations, none gathered whole.

Turns are sorted over the cluster by conversation and turn, so a conversation of
any length is a stretch of neighbouring partitions. Every partition numbers and
hashes its own rows as if a conversation began with them; what a conversation
has in earlier partitions is combined on the driver, from the first and the last
row of each partition, and added to the rows in a second pass over the stored
table.

A prefix is known by two polynomials over a prime field, together 122 bits, and
its length. Polynomials of two parts give that of the whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, stored

PRIME = (1 << 61) - 1
BASES = (0x12B9B0A1D3F2C5E7 % PRIME, 0x0F1E3A9C5D7B2846 % PRIME)

STATE_SCHEMA = (
    "part int, part_start boolean, part_end boolean, conv_id bigint, depth bigint, p1 bigint, "
    "p2 bigint, q1 bigint, q2 bigint, n_bytes bigint, total_bytes bigint, last boolean"
)
STATE_NAMES = [part.split()[0] for part in STATE_SCHEMA.split(", ")]


@dataclass(frozen=True)
class State:
    """What a conversation comes to after some of its turns."""

    conv_id: int
    depth: int
    p1: int
    p2: int
    total_bytes: int

    def then(self, other: State) -> State:
        """The state after the turns of ``other``, which follow these."""
        p1, p2 = (
            (ours * pow(base, other.depth, PRIME) + theirs) % PRIME
            for base, ours, theirs in zip(
                BASES, (self.p1, self.p2), (other.p1, other.p2), strict=True
            )
        )
        return State(
            self.conv_id, self.depth + other.depth, p1, p2, self.total_bytes + other.total_bytes
        )


def _advance(p1: int, p2: int, digest: bytes) -> tuple[int, int]:
    """The two polynomials after one more turn."""
    one, two = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:16], "big")
    return (p1 * BASES[0] + one + 1) % PRIME, (p2 * BASES[1] + two + 1) % PRIME


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States of sorted rows, counted from the partition's first row on."""
    # One row is held back: only its successor tells whether it is the last.
    held, conv = None, None
    depth = p1 = p2 = total = 0
    first = True

    def batch_of(rows: list[list], extra: list[tuple], source: pa.Schema) -> pa.RecordBatch:
        types = [pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 8, pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)]
        more = zip(zip(*extra, strict=True), source.types[4:], strict=True) if extra[0] else []
        columns += [pa.array(c, k) for c, k in more]
        return pa.RecordBatch.from_arrays(columns, [*STATE_NAMES, *source.names[4:]])

    schema = None
    for batch in batches:
        schema = batch.schema
        rows, extras = [], []
        figures = [batch.column(i).to_pylist() for i in range(4)]
        carried = [batch.column(i) for i in range(4, batch.num_columns)]
        for n, (part, conv_id, digest, n_bytes) in enumerate(zip(*figures, strict=True)):
            if first or conv_id != conv:
                if held is not None:
                    held[0][-1] = True
                conv, depth, p1, p2, total = conv_id, 0, 0, 0, 0
            q1, q2 = p1, p2
            p1, p2 = _advance(p1, p2, digest)
            depth, total = depth + 1, total + n_bytes
            if held is not None:
                rows.append(held[0])
                extras.append(held[1])
            state = [part, first, False, conv_id, depth, p1, p2, q1, q2, n_bytes, total, False]
            held = state, tuple(column[n].as_py() for column in carried)
            first = False
        if rows:
            yield batch_of(rows, extras, schema)
    if held is not None:
        held[0][2] = held[0][-1] = True
        yield batch_of([held[0]], [held[1]], schema)


def _carries(states: DataFrame) -> tuple[dict[int, State], set[int]]:
    """By partition, the state its first conversation comes with; and the
    partitions whose last conversation goes on in the next.

    Two rows of each partition, whatever the number of turns.
    """
    edges = states.where("part_start OR part_end").select(
        "part", "part_start", "part_end", "conv_id", "depth", "p1", "p2", "total_bytes"
    )
    starts, ends = {}, {}
    for row in edges.collect():
        if row.part_start:
            starts[row.part] = row.conv_id
        if row.part_end:
            ends[row.part] = State(row.conv_id, row.depth, row.p1, row.p2, row.total_bytes)
    carries, going_on, before = {}, set(), None
    for part in sorted(starts):
        here = ends[part]
        if before is not None and before[1].conv_id == starts[part]:
            carries[part] = before[1]
            going_on.add(before[0])
            if here.conv_id == starts[part]:
                here = before[1].then(here)
        before = part, here
    return carries, going_on


def _with_carries(states: DataFrame) -> DataFrame:
    """``states`` as counted from the conversations' first turns on."""
    carries, going_on = _carries(states)
    if not carries:
        return states

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {
                name: batch.column(name).to_numpy(zero_copy_only=False).copy()
                for name in STATE_NAMES
            }
            parts = columns["part"]
            for part in set(np.unique(parts).tolist()) & set(carries):
                carry = carries[part]
                for n in np.flatnonzero((parts == part) & (columns["conv_id"] == carry.conv_id)):
                    depth = int(columns["depth"][n])
                    for p, at in (("p1", depth), ("p2", depth), ("q1", depth - 1), ("q2", depth - 1)):
                        base, ours = (
                            (BASES[0], carry.p1) if p.endswith("1") else (BASES[1], carry.p2)
                        )
                        columns[p][n] = (
                            ours * pow(base, at, PRIME) + int(columns[p][n])
                        ) % PRIME
                    columns["depth"][n] += carry.depth
                    columns["total_bytes"][n] += carry.total_bytes
            for part in set(np.unique(parts).tolist()) & going_on:
                columns["last"] &= ~((parts == part) & columns["part_end"])
            arrays = [pa.array(columns[name], batch.schema.field(name).type) for name in STATE_NAMES]
            arrays += [batch.column(i) for i in range(len(STATE_NAMES), batch.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return states.mapInArrow(shift, states.schema)


def prefixes(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every turn with its ``depth`` in its conversation (1 for the first), the
    prefix that ends with it (``p1, p2``) and the one before (``q1, q2``), the
    bytes of its text and of all texts so far, and whether it is the ``last``.

    Turns come in ascending order, null first; those with one number by a hash
    of role and text. Null roles and texts are empty. Rows without a
    conversation id belong to none and are left out. ``carry`` names columns
    of ``role`` and ``text`` that are kept.
    """
    role_text = F.concat(
        F.octet_length(body("role")).cast("string"), F.lit(":"), body("role"), body("text")
    )
    kept = {"role": body("role").alias("role"), "text": body("text").alias("text")}
    rows = (
        picked(turns, conv_id=conv_id, turn=turn, role=role, text=text)
        .where("conv_id IS NOT NULL")
        .select(
            F.col("conv_id").cast("bigint"),
            F.col("turn").cast("bigint"),
            F.unhex(F.substring(F.sha2(role_text, 256), 1, 32)).alias("digest"),
            F.octet_length(body("text")).cast("bigint").alias("n_bytes"),
            *[kept[name] for name in carry],
        )
    )
    order = ["conv_id", "turn", "digest"]
    dealt = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "conv_id", "digest", "n_bytes", *carry)
    )
    schema = STATE_SCHEMA + "".join(f", {name} string" for name in carry)
    return _with_carries(stored(dealt.mapInArrow(_along, schema)))
