"""Grouped counts and their ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import RunStamp, field


def count_by(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Rows per key combination, NULL keys included.

    Tasks count before the shuffle, so a hot key costs one row per task.
    """
    return df.groupBy(*[field(key) for key in keys]).agg(F.count("*").alias(out))


def stamped(df: DataFrame, run: RunStamp) -> DataFrame:
    """``df`` with the run's ``ts_proc`` and ``ref_partition`` appended."""
    return df.withColumns(
        {
            "ts_proc": F.lit(run.ts_proc).cast("bigint"),
            "ref_partition": F.lit(run.ref_partition).cast("int"),
        }
    )


def ranked(df: DataFrame, count: str, keys: Sequence[str]) -> DataFrame:
    """Largest count first; equal counts by the keys, NULL first."""
    return df.orderBy(field(count).desc(), *[field(key).asc_nulls_first() for key in keys])


def top(df: DataFrame, count: str, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of the ranking, without sorting the rest."""
    return ranked(df, count, keys).limit(n)


def count_by_sql(df: DataFrame, keys: Sequence[str], out: str, run: RunStamp) -> DataFrame:
    """The stamped, ranked count as SQL text.

    The frame and the stamps are arguments: no session-wide view is registered
    and no value is formatted into the text.
    """
    names = ["`" + name.replace("`", "``") + "`" for name in [*keys, out]]
    key_list = ", ".join(names[:-1])
    return df.sparkSession.sql(
        f"""
        SELECT {key_list},
               count(*) AS {names[-1]},
               cast(:ts_proc AS bigint) AS ts_proc,
               cast(:ref_partition AS int) AS ref_partition
        FROM {{rows}}
        GROUP BY {key_list}
        ORDER BY {names[-1]} DESC, {key_list}
        """,
        args={"ts_proc": run.ts_proc, "ref_partition": run.ref_partition},
        rows=df,
    )
