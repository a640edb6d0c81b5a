"""Chat formatting at the token level.

A turn's role and text are escaped, encoded separately and spliced between
reserved ids that no text can produce: ``TURN role BODY text END``. Offsets and
the loss mask are prefix sums of token counts. The output is one row per turn,
so a conversation of any length is never gathered into one row.

Control strings inside texts get a backslash after their first character (those
that have backslashes there get one more), so that rendered text cannot be
mistaken for markup and the original can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, values
from tarn.llm.tokens import vocabulary

# The template's control strings, in the order of their ids above
# the vocabulary, and what may follow the opening bracket of a control string.
CONTROL_STRINGS = ["<|turn|>", "<|body|>", "<|end|>"]
TURN, BODY, END = range(3)
CONTROL_TAILS = [r"\|", r"/?s>", r"/?INST\]", r"<SYS>>", r"</SYS>>"]

_TAIL = f"(?={'|'.join(CONTROL_TAILS)})"
_TO_ESCAPE = re.compile(r"([<\[])(\\*)" + _TAIL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _TAIL)

LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


ROW_SCHEMA = (
    "conv_id bigint, turn bigint, role_key string, text_key bigint, token_ids array<int>, "
    "tokens bigint, loss_from bigint, loss_tokens bigint, chars bigint"
)


def _encoded(rows: DataFrame, path: str, loss_role: str) -> DataFrame:
    """Each turn's ids, and where in them the loss falls. One row in, one out."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        reserved = [np.array([words.size + n], "<u4") for n in range(3)]
        frame = sum(map(len, CONTROL_STRINGS))
        for batch in batches:
            ids, figures = [], []
            for role, text in zip(
                values(batch.column("role")), values(batch.column("text")), strict=True
            ):
                safe_role, safe_text = escape(role), escape(text)
                role_ids, text_ids = words.ids(safe_role), words.ids(safe_text)
                ids.append(
                    np.concatenate(
                        [reserved[TURN], role_ids, reserved[BODY], text_ids, reserved[END]]
                    )
                )
                loss = len(text_ids) if role == loss_role else 0
                chars = frame + len(safe_role) + len(safe_text)
                figures.append((len(ids[-1]), len(role_ids) + 2, loss, chars))
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            columns = np.array(figures, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    batch.column("role"),
                    batch.column("text_key"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    *[pa.array(c) for c in columns],
                ],
                [part.split()[0] for part in ROW_SCHEMA.split(", ")],
            )

    return rows.mapInArrow(encode, ROW_SCHEMA)


def format_chat(
    turns: DataFrame,
    path: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """One row per turn: ``conv_id, turn, token_ids, start, loss_start, loss_tokens, chars``.

    ``start`` is the turn's first token in its conversation, and the loss covers
    ``loss_tokens`` tokens from ``loss_start``: the text of turns whose role is
    ``loss_role``, without reserved ids. ``chars`` is the length of the rendered
    turn. Rows are partitioned by conversation and sorted by turn.

    Null roles and texts are empty. Null turns come first, and turns with the
    same number are ordered by role and then by a hash of the text. Null
    conversation ids form one conversation. Repeated rows are turns of their
    own. An empty table gives no rows; further columns do not matter.
    """
    rows = picked(turns, conv_id=conv_id, turn=turn, role=role, text=text).select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        body("role").alias("role"),
        body("text").alias("text"),
        F.xxhash64(body("text")).alias("text_key"),
    )
    order = ["turn", "role_key", "text_key"]
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    start = F.sum("tokens").over(before) - F.col("tokens")
    return (
        _encoded(rows, path, loss_role)
        .withColumn("start", start)
        .select(
            "conv_id",
            "turn",
            "token_ids",
            "start",
            (F.col("start") + F.col("loss_from")).alias("loss_start"),
            "loss_tokens",
            "chars",
        )
    )


DIGEST_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """What ``format_chat`` wrote, per conversation, read from the ids and the mask.

    Rows are brought together by conversation and sorted, unless they lie so
    already, and streamed over: one batch and the digests of one conversation
    are held. ``formatted_chars`` counts the rendered text, control strings and
    escapes included, as the ids decode to it.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        open_conv, state = False, None

        def closed() -> tuple:
            conv, turns, whole, loss_chars, loss, chars = state
            return conv, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [part.split()[0] for part in DIGEST_SCHEMA.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        for batch in batches:
            rows = []
            figures = [
                batch.column(name).to_pylist()
                for name in ("conv_id", "start", "loss_start", "loss_tokens")
            ]
            lists = batch.column("token_ids")
            for n, (conv, start, loss_start, loss_tokens) in enumerate(
                zip(*figures, strict=True)
            ):
                if not open_conv or conv != state[0]:
                    if open_conv:
                        rows.append(closed())
                    open_conv = True
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = lists[n].values.to_numpy()
                marks = np.flatnonzero(ids >= words.size)
                turn, body_mark, end = marks.tolist()
                safe_role = words.text(ids[turn + 1 : body_mark])
                safe_text = words.text(ids[body_mark + 1 : end])
                role, text = unescape(safe_role), unescape(safe_text)
                chars = len(safe_role) + len(safe_text)
                chars += sum(len(CONTROL_STRINGS[i - words.size]) for i in ids[marks].tolist())
                loss_ids = ids[loss_start - start : loss_start - start + loss_tokens]
                loss = unescape(words.text(loss_ids))
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += chars
            if rows:
                yield as_batch(rows)
        if open_conv:
            yield as_batch([closed()])

    # Numbering the turns asks for the partitioning, which Spark keeps if it is there.
    by_start = Window.partitionBy("conv_id").orderBy("start")
    ordered = formatted.select(
        "conv_id", "start", "loss_start", "loss_tokens", "token_ids",
        F.row_number().over(by_start).alias("place"),
    )
    return ordered.mapInArrow(digest, DIGEST_SCHEMA)
