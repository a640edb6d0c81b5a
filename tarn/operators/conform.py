"""Cleaning: raw records to Bronze cells, Bronze cells to typed Silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import (
    RunStamp,
    blank_missing,
    coerce_number,
    field,
    tidy_number,
    tidy_text,
)


def normalize(df: DataFrame, text: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Raw records as Bronze cells.

    The listed columns that are present become blank-free text or doubles; any
    other column passes through untouched.
    """
    cells = {}
    for name in df.columns:
        if name in numbers:
            cells[name] = coerce_number(field(name))
        elif name in text:
            cells[name] = blank_missing(field(name))
    return df.select(*[cells.get(name, field(name)).alias(name) for name in df.columns])


def conform(
    df: DataFrame, columns: Sequence[str], numbers: Sequence[str], run: RunStamp
) -> DataFrame:
    """Typed Silver rows: run stamps, then ``columns`` in order and nothing else."""
    stamps = [
        F.lit(run.ref).cast("int").alias("ref"),
        F.lit(run.ref_partition).cast("int").alias("ref_partition"),
        F.lit(run.ts_proc).cast("bigint").alias("ts_proc"),
        F.lit(run.ts_proc).cast("bigint").alias("ts_proc_partition"),
    ]
    cells = [
        (tidy_number if name in numbers else tidy_text)(field(name)).alias(name)
        for name in columns
    ]
    return df.select(*stamps, *cells)
