"""Token ids, chat formatting and packing."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oddities import TEXTS, empty, frame, odd
from tokenizers import Tokenizer

from tarn.llm import packing
from tarn.llm.chat import CONTROL_STRINGS, escape, format_chat, read_back, unescape
from tarn.llm.common import stored
from tarn.llm.packing import END_ID, fit_counts, pack_documents, plan_sequences
from tarn.llm.queries import HOSTILE_CONVERSATION, QUERIES, VOCABULARY
from tarn.llm.tokens import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


TRICKY = st.text(
    st.one_of(
        st.sampled_from(" \n\t\r'<>[]|\\/sINST<|>\x1c\x1d\x85 　​ é\U0001f600"),
        st.characters(exclude_categories=["Cs"]),
    ),
    max_size=60,
)


@settings(max_examples=300, deadline=None)
@given(TRICKY)
def test_ids_are_those_of_the_library(tokenizer, text):
    own = vocabulary(VOCABULARY)
    ids = own.ids(text)
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert own.text(ids) == text


def test_ids_of_whole_documents(tokenizer, sf_dir):
    texts = [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{sf_dir}/documents.parquet'").fetchall()]
    own = vocabulary(VOCABULARY)
    for text, encoded in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.ids(text).tolist() == encoded.ids


PLANTED = st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " "]), TRICKY), max_size=6)


@settings(max_examples=300, deadline=None)
@given(PLANTED.map("".join))
def test_ids_with_added_tokens_are_those_of_the_library_as_it_comes(text):
    own = vocabulary(VOCABULARY).ids_with_added(text)
    assert own.tolist() == as_it_comes().encode(text, add_special_tokens=False).ids


@lru_cache
def as_it_comes():
    return Tokenizer.from_file(VOCABULARY)


def test_packing_gives_added_tokens_their_ids(spark):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> <|endoftext|>\n y " * 400, "<|endoftext"]
    ids_of = {
        n: np.array([*as_it_comes().encode(text, add_special_tokens=False).ids, END_ID], "<u4")
        for n, text in enumerate(texts)
    }
    assert ids_of[0].tolist() == [64, 50256, 65, END_ID]
    check_pieces(pack_documents(frame(spark, list(enumerate(texts))), VOCABULARY).collect(), ids_of)


CONTROLS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", *CONTROL_STRINGS]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*CONTROLS, "\\", "<", "[", "|", "s>", "/"]), TRICKY)).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    safe = escape(text)
    assert unescape(safe) == text
    assert not any(control in safe for control in CONTROLS)


def plain_chat(rows):
    """(conv_id, turn, role, text) rows to what the query must return."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text or ""))
    found = {}
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        found[conv] = (
            len(turns),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return found


def test_chat_query_reads_back_every_turn(spark, sf_dir):
    query = f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet'"
    rows = duckdb.connect().execute(query).fetchall() + HOSTILE_CONVERSATION
    got = QUERIES["op7_chat_formatting"](spark, sf_dir).collect()
    assert {r.conv_id: tuple(r[1:5]) for r in got} == plain_chat(rows)
    by = {r.conv_id: r.formatted_chars for r in got}
    frame = sum(map(len, CONTROL_STRINGS))
    hostile = sum(frame + len(r) + len(escape(t)) for _, _, r, t in HOSTILE_CONVERSATION)
    assert by[-7] == hostile


def test_chat_of_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", "a<|end|>b"), (1, 1, "assistant", "a<|end|>b"),
        (2, None, None, "x" * 200_000), (2, 0, "assistant", ""), (None, 3, "user", "no id"),
        (None, 4, "assistant", "yes"), (3, 0, "<|turn|>", "role"),
    ]
    turns = spark.createDataFrame(
        [(*row, 5, [1]) for row in rows],
        "conv_id long, turn long, role string, text string, start long, token_ids array<int>",
    )
    made = format_chat(turns, VOCABULARY)
    starts = [(r.start, len(r.token_ids)) for r in made.where("conv_id = 1").orderBy("start").collect()]
    assert starts[0][0] == 0 and [s for s, _ in starts[1:]] == list(np.cumsum([n for _, n in starts]))[:-1]
    got = {r.conv_id: tuple(r[1:5]) for r in read_back(made, VOCABULARY).collect()}
    fixed = [(c, -1 if t is None else t, r or "", x) for c, t, r, x in rows]
    assert got == plain_chat(fixed)
    none = turns.where("false")
    assert read_back(format_chat(none, VOCABULARY), VOCABULARY).collect() == []


def check_pieces(rows, ids_of, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, cut in by_doc.items():
        ids = ids_of[doc_id]
        at = 0
        for n, r in enumerate(sorted(cut, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == capacity or n == 0
            at += r.length
        assert at == len(ids)
    for spots in by_sequence.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_query(spark, sf_dir, tokenizer):
    rows = QUERIES["op9_best_fit_packing"](spark, sf_dir).collect()
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    encoded = tokenizer.encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    ids_of = {d: np.array([*e.ids, END_ID], "<u4") for (d, _), e in zip(docs, encoded, strict=True)}
    assert {r.doc_id for r in rows} == set(ids_of)
    made = check_pieces(rows, ids_of)
    assert made <= 1.01 * -(-sum(map(len, ids_of.values())) // 2048)


def test_packing_odd_rows(spark):
    rows = pack_documents(odd(spark), VOCABULARY, with_ids=True).collect()
    own = vocabulary(VOCABULARY)
    total = sum(len(own.ids(text or "")) + 1 for _, text in TEXTS)
    assert sum(r.length for r in rows) == total == sum(len(r.token_ids) for r in rows)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    for r in rows:
        assert zlib.crc32(np.array(r.token_ids, "<u4").tobytes()) == r.ids_crc32
    assert pack_documents(empty(spark), VOCABULARY).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 500)), max_size=40))
def test_plans_use_the_histogram_up(parts):
    histogram = np.zeros(65, np.int64)
    for length, count in parts:
        histogram[length] += count
    used = np.zeros(65, np.int64)
    plan = plan_sequences(histogram, 64)
    for lengths, times in plan:
        assert sum(lengths) <= 64 and times > 0
        for length in lengths:
            used[length] += times
    assert (used == histogram).all()
    # Best-fit decreasing needs at most 11/9 of the least, and one.
    least = -(-int((np.arange(65) * histogram).sum()) // 64)
    large = int(histogram[33:].sum())
    assert sum(times for _, times in plan) <= max(least, large) * 1.7 + 1


def test_fit_finds_an_exact_solution():
    patterns = np.array([[40, 24, 0, 0], [32, 32, 0, 0], [40, 12, 12, 0]])
    uses = np.array([30.0, 50.0, 20.0])
    histogram = np.zeros(65)
    for pattern, times in zip(patterns, uses, strict=True):
        for length in pattern[pattern > 0]:
            histogram[length] += times
    assert fit_counts(patterns, histogram) == pytest.approx(uses, rel=0.01)


def test_lengths_of_many_pieces_are_ranked_in_more_parts(spark, monkeypatch):
    """Half of all pieces have one length, and parts hold 20 pieces."""
    monkeypatch.setattr(packing, "RANK_PARTS", 2)
    monkeypatch.setattr(packing, "PART_PIECES", 20)
    rng = random.Random(3)
    rows = [(n // 2, n % 2, 0, 64 if n % 2 else rng.randint(1, 64), n) for n in range(2000)]
    cut = stored(spark.createDataFrame(rows, packing.PIECE_SCHEMA))
    packed = packing.pack_pieces(cut, 64).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(rows)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_read_back_over_a_stored_table(spark):
    """The written turns lie in any order, a conversation's in many files."""
    turns = [(c, t, "assistant" if t % 2 else "user", f"[INST] {c} {t}") for c in range(9) for t in range(12)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    made = format_chat(df, VOCABULARY)
    fresh = sorted(map(tuple, read_back(made, VOCABULARY).collect()))
    table = stored(made.repartition(7, "start"))
    assert sorted(map(tuple, read_back(table, VOCABULARY).collect())) == fresh
    assert [r[0] for r in fresh] == list(range(9))
    rendered = sum(len("<|turn|><|body|><|end|>") + len(role) + len(text) + 1 for c, _, role, text in turns if c == 0)
    assert fresh[0][-1] == rendered
