"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import field
from tarn.sources import scratch_folder

BATCH_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000

# Slots of a membership filter: for each key, at least (one page), and at most
# (128 MiB, some 100 million keys).
SLOTS_PER_KEY = 10
LEAST_SLOTS = 1 << 15
MOST_SLOTS = 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def body(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(field(column).cast("string"), F.lit(""))


def values(column: pa.Array) -> Iterator:
    """A column's values one by one: a batch of long texts is not copied at once."""
    return (value.as_py() for value in column)


def bound_batches(spark: SparkSession) -> None:
    """Hand Python workers few texts at a time, unless the session says how many.

    The default of 10,000 rows is some 100 MB of long texts per worker, and as
    much again in the JVM.
    """
    if spark.conf.get(BATCH_ROWS_CONF, None) is None:
        spark.conf.set(BATCH_ROWS_CONF, BATCH_ROWS)


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Columns of ``df`` by their exact names, under new ones.

    Other columns don't matter, not even ones that differ by case only.
    """
    held = hold(df)
    bound_batches(df.sparkSession)
    return held.select(
        *[F.col(f"_c{df.columns.index(old)}").alias(new) for new, old in names.items()]
    )


def hold(df: DataFrame) -> DataFrame:
    """``df`` with its columns renamed by place, so that none clashes with ours."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def release(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that ``hold`` renamed, under their own names again."""
    return df.select(*[F.col(f"_c{i}").alias(name) for i, name in enumerate(columns)])


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a new folder that all executors share, and read again.

    Cuts the lineage: what follows survives the loss of any executor without
    running ``df`` again.
    """
    path = f"{scratch_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Filter:
    """A membership filter: pages of bits, and the number of bits in all."""

    pages: DataFrame
    slots: int


def _slot(keys: list[Column], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots).cast("bigint")) + 1


def filter_pages(keys: DataFrame, most_slots: int = MOST_SLOTS) -> Filter:
    """A membership filter over the rows of ``keys``: one bit per hash slot.

    There are ``SLOTS_PER_KEY`` slots for each key, so one row in ten or fewer
    passes that is not in it, up to ``most_slots``, which bounds what is
    broadcast. With more keys than those hold, more rows pass, and none is
    lost: it has no false negatives, and a caller must be exact on its own.
    """
    held = stored(keys.distinct())
    wanted = SLOTS_PER_KEY * held.count()
    slots = min(most_slots, max(LEAST_SLOTS, 1 << (wanted - 1).bit_length() if wanted else 0))
    slot = _slot([field(name) for name in held.columns], slots)
    pages = (
        held.select(
            F.bitmap_bucket_number(slot).alias("page"),
            F.bitmap_bit_position(slot).alias("position"),
        )
        .groupBy("page")
        .agg(F.bitmap_construct_agg("position").alias("page_bits"))
    )
    return Filter(pages, slots)


def flag_members(df: DataFrame, keys: list[Column], members: Filter, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: false only where the keys are not in the filter.

    The pages are broadcast: ``most_slots / 8`` bytes at most by construction.
    ``df`` is not shuffled.
    """
    slot = _slot(keys, members.slots)
    pages = members.pages
    position = F.bitmap_bit_position(slot).cast("int")
    byte = F.substring("page_bits", F.floor(position / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), position % 8)
    joined = df.join(F.broadcast(pages), F.bitmap_bucket_number(slot) == pages["page"], "left")
    return joined.select(df["*"], F.coalesce(bit == 1, F.lit(False)).alias(flag))


def without_ids(docs: DataFrame, doc_id: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped`` (one column of ids).

    Only rows that the membership filter lets through are shuffled, so texts
    that stay are not, but for false positives.
    """
    ids = dropped.select(F.col(dropped.columns[0]).cast("bigint").alias("dropped_id")).where(
        "dropped_id IS NOT NULL"
    )
    key = F.col(f"_c{docs.columns.index(doc_id)}").cast("bigint")
    flagged = flag_members(hold(docs), [key], filter_pages(ids), "maybe_dropped")
    suspects = flagged.where("maybe_dropped")
    left = suspects.join(ids, key == F.col("dropped_id"), "left_anti")
    return release(flagged.where("NOT maybe_dropped").union(left), docs.columns)
