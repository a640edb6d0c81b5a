"""The trie of conversation prefixes, with what sharing a prefix saves.

A node is a distinct sequence of first turns, known by its hash and depth; its
members are the conversations that begin with it. Along a conversation the
member sets shrink, and nodes with one member set form a chain. A chain is known
by its least member and its size, and a trie over c conversations has fewer than
2c of them, however long the conversations are. Subtrees are summed over chains;
a node inside a chain takes off what lies above it.

Chains are sharded: below a node with at most ``shard`` members whose parent has
more, the whole subtree goes to one shard, which writes its chains as balanced
parentheses and sums subtrees by them. The nodes above are the spine that shards
share. Every spine node has a row of its own for each of more than ``shard``
members, so there are at most rows / ``shard`` of them, and ``shard`` grows with
the rows so that they stay below ``MOST_SPINE``. The spine takes in the sums of
the shards under it and is written as parentheses in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import picked, stored
from tarn.llm.parentheses import Parentheses
from tarn.llm.turns import prefixes

# Conversations of a shard, and nodes of the spine, at most.
SHARD = 4096
MOST_SPINE = 100_000
# Conversation ids whose numbers differ in so many low bits are listed together.
LISTED_BITS = 10

NODE = ["depth", "p1", "p2"]
NOTHING = hashlib.sha256().hexdigest()


def _nodes(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``depth, p1, p2``, the parent's ``q1, q2``, members, least member, bytes."""
    below = rows.groupBy(*NODE).agg(
        F.min("q1").alias("q1"),
        F.min("q2").alias("q2"),
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("n_bytes").alias("n_bytes"),
        F.min("total_bytes").alias("total_bytes"),
    )
    zero = F.lit(0).cast("bigint")
    root = members.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where(
        "n_convs > 0"
    )
    none = F.lit(None).cast("bigint")
    top = root.select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), none.alias("q1"),
        none.alias("q2"), "n_convs", "conv_id", zero.alias("n_bytes"), zero.alias("total_bytes"),
    )
    return stored(below.union(top))


def _chains(nodes: DataFrame, spine: DataFrame) -> DataFrame:
    """One row per chain: ``conv_id, n_convs``, where it begins and ends, its
    bytes, and the chain above, ``up_conv, up_n`` (null for the root's).

    A parent on the spine may have any number of children, and is looked up in
    the broadcast spine; the others have fewer than a shard's members.
    """
    chains = nodes.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"),
        F.max("depth").alias("bottom"),
        F.sum("n_bytes").alias("chain_bytes"),
        F.min(F.struct("depth", "q1", "q2", (F.col("total_bytes") - F.col("n_bytes")).alias("b")))
        .alias("head"),
    ).select(
        "conv_id", "n_convs", "top", "bottom", "chain_bytes",
        (F.col("top") - 1).alias("u_depth"), F.col("head.q1").alias("u1"),
        F.col("head.q2").alias("u2"), F.col("head.b").alias("bytes_before"),
    )

    def parent_of(table: DataFrame) -> DataFrame:
        return table.select(
            *[F.col(old).alias(new) for old, new in zip(NODE, ("u_depth", "u1", "u2"), strict=True)],
            F.col("conv_id").alias("up_conv"),
            F.col("n_convs").alias("up_n"),
        )

    key = ["u_depth", "u1", "u2"]
    near = stored(chains.join(F.broadcast(parent_of(spine)), key, "left"))
    deep = near.where("up_conv IS NULL AND top > 0").drop("up_conv", "up_n")
    found = deep.join(parent_of(nodes), key, "left")
    return stored(near.where("up_conv IS NOT NULL OR top = 0").unionByName(found).drop(*key))


IN_SHARD = (
    "s1 bigint, s2 bigint, conv_id bigint, n_convs bigint, up_conv bigint, up_n bigint, "
    "weight bigint, below_children bigint, below_leaves bigint, below_saved bigint"
)
SUMMED = (
    "conv_id bigint, n_convs bigint, up_conv bigint, up_n bigint, is_root boolean, "
    "children bigint, leaves bigint, saved bigint"
)
SUMMED_NAMES = [part.split()[0] for part in SUMMED.split(", ")]


def _sum_shard(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Subtree sums of one shard's chains, which come parents first."""
    keys = list(zip(rows["conv_id"].tolist(), rows["n_convs"].tolist(), strict=True))
    place = {key: n for n, key in enumerate(keys)}
    ups = list(zip(rows["up_conv"].tolist(), rows["up_n"].tolist(), strict=True))
    parents = [place.get(up, -1) for up in ups]
    tree = Parentheses(parents)
    closes = tree.closes()
    children = np.bincount(
        np.array([p for p in parents if p >= 0], np.int64), minlength=len(keys)
    )
    # A chain under which only other shards hang is a pair here and yet no leaf.
    covered = (children == 0) & (rows["below_children"] > 0)
    leaves = tree.leaves(closes) + tree.sums(closes, rows["below_leaves"] - covered)
    saved = tree.sums(closes, rows["weight"] + rows["below_saved"])
    roots = np.array(parents, np.int64) < 0
    columns = [
        rows["conv_id"], rows["n_convs"], rows["up_conv"], rows["up_n"], roots,
        children + rows["below_children"], leaves, saved,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], SUMMED_NAMES)


def _sum_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of sorted rows, one held at a time."""
    held: list[dict[str, np.ndarray]] = []
    shard = None

    def joined() -> pa.RecordBatch:
        return _sum_shard({name: np.concatenate([h[name] for h in held]) for name in held[0]})

    for batch in batches:
        rows = {
            name: batch.column(name).fill_null(-1).to_numpy(zero_copy_only=False)
            for name in batch.schema.names
        }
        s1, s2 = rows["s1"], rows["s2"]
        cuts = np.flatnonzero((np.diff(s1) != 0) | (np.diff(s2) != 0)) + 1
        edges = [0, *cuts.tolist(), len(s1)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if start == end:
                continue
            if shard is not None and shard != (s1[start], s2[start]):
                yield joined()
                held = []
            shard = (s1[start], s2[start])
            held.append({name: column[start:end] for name, column in rows.items()})
    if held:
        yield joined()


def _summed(chains: DataFrame) -> DataFrame:
    dealt = chains.repartition("s1", "s2").sortWithinPartitions(
        "s1", "s2", F.desc("n_convs"), "conv_id"
    )
    names = [part.split()[0] for part in IN_SHARD.split(", ")]
    return stored(dealt.select(*names).mapInArrow(_sum_shards, SUMMED))


def _subtrees(chains: DataFrame, rows: DataFrame, spine: DataFrame, shard: int) -> DataFrame:
    """``children, leaves, saved`` of every chain's subtree."""
    zero = F.lit(0).cast("bigint")
    weighed = chains.withColumn("weight", (F.col("n_convs") - 1) * F.col("chain_bytes"))
    on_spine = (F.col("n_convs") > shard) | (F.col("top") == 0)
    keys = spine.select(*NODE)
    roots = (
        rows.join(F.broadcast(keys), NODE, "left_anti")
        .groupBy(F.col("conv_id").alias("s_conv"))
        .agg(F.min(F.struct(*NODE)).alias("root"))
        .select("s_conv", F.col("root.p1").alias("s1"), F.col("root.p2").alias("s2"))
    )
    none = {f"below_{name}": zero for name in ("children", "leaves", "saved")}
    inside = weighed.where(~on_spine).join(roots, F.col("conv_id") == F.col("s_conv"))
    shards = _summed(inside.withColumns(none))
    hanging = shards.where("is_root").groupBy("up_conv", "up_n").agg(
        F.count("*").alias("below_children"),
        F.sum("leaves").alias("below_leaves"),
        F.sum("saved").alias("below_saved"),
    )
    # As many rows as the spine has, at most.
    hanging = hanging.select(
        F.col("up_conv").alias("h_conv"), F.col("up_n").alias("h_n"), *none
    )
    shared = weighed.where(on_spine).join(
        hanging, (F.col("conv_id") == F.col("h_conv")) & (F.col("n_convs") == F.col("h_n")), "left"
    )
    shared = shared.fillna(0, list(none)).withColumns({"s1": zero, "s2": zero})
    return shards.unionByName(_summed(shared)).select(
        F.col("conv_id").alias("t_conv"), F.col("n_convs").alias("t_n"),
        "children", "leaves", "saved",
    )


ENDS_SCHEMA = "e_depth bigint, e1 bigint, e2 bigint, ends_sha256 string"


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids, listed in blocks that come in order."""
    names = [part.split()[0] for part in ENDS_SCHEMA.split(", ")]
    node, digest = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    for batch in batches:
        done = []
        for *key, listed in zip(
            *(batch.column(name).to_pylist() for name in (*NODE, "listed")), strict=True
        ):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(listed.encode())
        if done:
            yield out(done)
    if node is not None:
        yield out([(*node, digest.hexdigest())])


def _ends(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The digest of the ids of the conversations that end at a node.

    Ids are listed in blocks of at most 2 ** ``LISTED_BITS``, which the tasks
    share; only the digest, which is one after another by nature, sees all
    blocks of a node, and one at a time.
    """
    turnless = members.join(rows.select("conv_id").distinct(), "conv_id", "left_anti")
    zero = F.lit(0).cast("bigint")
    ends = rows.where("last").select(*NODE, "conv_id").union(
        turnless.select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id")
    )
    block = F.shiftright("conv_id", LISTED_BITS).alias("block")
    listed = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    blocks = ends.groupBy(*NODE, block).agg(F.array_join(listed, ",").alias("listed"))
    dealt = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block")
    return dealt.mapInArrow(_digest_ends, ENDS_SCHEMA)


def prefix_trie(
    turns: DataFrame,
    members: DataFrame | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shard: int = SHARD,
) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``,
    ``n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``n_leaves`` counts the childless nodes of the subtree, and ``saved_tokens``
    adds up (members - 1) x the UTF-8 bytes of the last text over its nodes.
    ``ends_sha256`` digests the ids of the members that have no further turn,
    ascending and joined by commas. ``members`` names all conversations in its
    column ``conv_id``; those without turns are members of the root alone. Left
    out, they are the conversations of ``turns``.

    Turns are ordered as ``turns.prefixes`` says; null roles and texts are
    empty, and rows without a conversation id belong to no conversation. Rows
    that are repeated are turns of their own. Without conversations there are
    no rows, not even a root. Further columns do not matter.
    """
    rows = stored(prefixes(turns, conv_id, turn, role, text))
    named = turns if members is None else members
    column = conv_id if members is None else "conv_id"
    ids = stored(
        picked(named, conv_id=column)
        .select(F.col("conv_id").cast("bigint"))
        .where("conv_id IS NOT NULL")
        .distinct()
    )
    nodes = _nodes(rows, ids)
    shard = max(shard, -(-rows.count() // MOST_SPINE))
    # At most rows / shard nodes, and the root.
    spine = nodes.where((F.col("n_convs") > shard) | (F.col("depth") == 0))
    chains = _chains(nodes, spine)
    sums = stored(
        _subtrees(chains, rows, spine, shard).join(
            chains, (F.col("t_conv") == F.col("conv_id")) & (F.col("t_n") == F.col("n_convs"))
        ).select(
            "t_conv", "t_n", "top", "bottom", "bytes_before", "up_conv", "children", "leaves", "saved"
        )
    )
    ends = stored(_ends(rows, ids))
    joined = nodes.join(
        sums, (F.col("conv_id") == F.col("t_conv")) & (F.col("n_convs") == F.col("t_n"))
    ).join(
        ends,
        (F.col("depth") == F.col("e_depth")) & (F.col("p1") == F.col("e1")) & (F.col("p2") == F.col("e2")),
        "left",
    )
    above = F.col("total_bytes") - F.col("n_bytes") - F.col("bytes_before")
    return joined.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("top"), F.col("conv_id"))
        .otherwise(F.col("up_conv"))
        .alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("depth") < F.col("bottom"), F.lit(1).cast("bigint"))
        .otherwise(F.col("children"))
        .alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n_convs") - 1) * above).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's input: conversations that begin like one in five.

    Conversation c takes the first h turns of conversation c - c % 5 and its own
    from the h-th on, h = crc32(decimal c) % 9. Returns the turns and the ids of
    all conversations.
    """
    placed = prefixes(conversations, carry=["role", "text"]).select(
        "conv_id", (F.col("depth") - 1).alias("turn"), "role", "text"
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    ids = picked(conversations, conv_id="conv_id").where("conv_id IS NOT NULL").distinct()
    takers = ids.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("of"))
    heads = placed.where("turn < 8").withColumnRenamed("conv_id", "of")
    taken = takers.where("h > 0").join(heads, "of").where("turn < h")
    own = placed.where(F.col("turn") >= h)
    return taken.select(*own.columns).union(own), ids
