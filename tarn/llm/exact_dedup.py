"""Exact deduplication by progressive refinement, in built-in functions only.

Rows are grouped by length and the hash of a prefix; only rows whose group has
company are hashed in full. The first scan counts (length, prefix hash) pairs,
so nothing but those pairs is shuffled. The pairs with company go into a
membership filter of fixed size, which the second scan consults row by row:
texts are never shuffled to find copies. A false positive of the filter costs a
full hash and nothing else, because groups are formed by the full hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import field
from tarn.llm.common import body, filter_pages, flag_members, hold, picked, release, stored

# Code points of the prefix that is hashed first.
PREFIX = 256


def _refined(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_size``, ``_may_repeat`` and, where that holds, ``_full``."""
    size = F.octet_length(body(text)).alias("_size")
    prefix = F.xxhash64(F.substring(body(text), 1, PREFIX)).alias("_prefix")
    company = docs.select(size, prefix).groupBy("_size", "_prefix").count().where("count > 1")
    flagged = flag_members(
        docs.select("*", size, prefix),
        [F.col("_size"), F.col("_prefix")],
        filter_pages(company.select("_size", "_prefix")),
        "_may_repeat",
    )
    full = F.when(F.col("_may_repeat"), F.sha2(body(text), 256))
    return flagged.withColumn("_full", full).drop("_prefix")


def _groups(refined: DataFrame, doc_id: str) -> DataFrame:
    """Per repeated text: the id that stays, its rows, and all rows.

    Counts per id come first, so that a text filling a third of the table is
    spread over its ids before it meets in one row. The groups are a written
    table: as such Spark knows their size, and can broadcast them if they are
    small or split a hot text's rows if they are not.
    """
    return stored(
        refined.where("_may_repeat")
        .groupBy("_size", "_full", field(doc_id).alias("_id"))
        .agg(F.count("*").alias("_rows"))
        .groupBy("_size", "_full")
        .agg(
            F.max(F.struct("_id", "_rows")).alias("_top"),
            F.sum("_rows").alias("_group_size"),
        )
        .where("_group_size > 1")
        .select(
            F.col("_size").alias("_g_size"),
            F.col("_full").alias("_g_full"),
            F.col("_top._id").alias("_keep_id"),
            F.col("_top._rows").alias("_keep_rows"),
            "_group_size",
        )
    )


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept``.

    Equal texts form a group, null counting as the empty text; the largest id
    of a group stays. A null id sorts below all others, so it stays only in a
    group of null ids. Rows that repeat both id and text are one document: all
    carry ``kept`` if that document stays (``drop_exact_copies`` leaves one).
    An empty table gives no rows. ``carry`` names further columns to return;
    the others, whatever their names, do not matter.
    """
    extra = {f"_c{i}": name for i, name in enumerate(carry)}
    refined = _refined(picked(docs, _d=doc_id, _t=text, **extra), "_t")
    groups = _groups(refined, "_d")
    # Rows without a full hash get a key of their own, so that they spread.
    key = F.coalesce(F.col("_full"), F.concat(F.lit("-"), F.xxhash64("_d", "_size")))
    joined = refined.withColumn("_key", key).join(
        groups, (F.col("_size") == F.col("_g_size")) & (F.col("_key") == F.col("_g_full")), "left"
    )
    in_group = F.col("_group_size").isNotNull()
    return joined.select(
        F.col("_d").alias(doc_id),
        F.when(in_group, F.col("_keep_id")).otherwise(F.col("_d")).alias("keep_id"),
        F.coalesce("_group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (~in_group | F.col("_d").eqNullSafe(F.col("_keep_id"))).alias("kept"),
        *[F.col(f"_c{i}").alias(name) for i, name in enumerate(carry)],
    )


def drop_exact_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only rows whose length and prefix have company are shuffled. Of rows that
    repeat both id and text one stays. Null ids and texts are as in
    ``exact_groups``.
    """
    columns = docs.columns
    held = hold(docs).withColumns(
        {
            "_d": F.col(f"_c{columns.index(doc_id)}"),
            "_t": F.col(f"_c{columns.index(text)}"),
        }
    )
    refined = _refined(held, "_t")
    groups = _groups(refined, "_d")
    suspects = refined.where("_may_repeat").join(
        groups,
        (F.col("_size") == F.col("_g_size")) & (F.col("_full") == F.col("_g_full")),
        "left",
    )
    stay = suspects.where(
        F.col("_group_size").isNull() | F.col("_d").eqNullSafe(F.col("_keep_id"))
    )
    once = stay.where(F.coalesce(F.col("_keep_rows"), F.lit(1)) == 1)
    again = stay.where("_keep_rows > 1").dropDuplicates(["_d", "_size", "_full"])
    parts = [refined.where("NOT _may_repeat"), once, again]
    return reduce(DataFrame.union, [release(part, columns) for part in parts])
