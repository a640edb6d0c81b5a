"""Parquet tables: partitioned, ranked, small and append-only ones.

Tables are published run by run (``tarn.sources.published``): the old rows are
read until the new ones are complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tarn.functions import field
from tarn.sources.published import (
    data_files,
    newest,
    newest_per_stamp,
    publish,
    run_folders,
)

MAX_RECORDS_PER_FILE = 5_000_000


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A handful of driver rows as a relation of known size.

    Through Arrow the plan holds the rows themselves (``LocalTableScan``), so
    Spark knows their size and needs no Python worker to scan them.
    """
    names = schema.fieldNames()
    table = pa.Table.from_pylist(
        [dict(zip(names, row, strict=True)) for row in rows], schema=to_arrow_schema(schema)
    )
    return spark.createDataFrame(table, schema=schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the run of ``path`` that counts, or its plain Parquet files.

    An explicit schema keeps partition values text (``01`` stays ``01``), and
    the projection undoes Spark's moving partition columns to the end. A run
    that has lost files fails the read.
    """
    folders = run_folders(spark, path, newest) or [path]
    if schema is None:
        return spark.read.parquet(*folders)
    names = [field(f) for f in schema.fieldNames()]
    return spark.read.schema(schema).parquet(*folders).select(*names)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """A log table: the rows of every stamp once, and those appended without one."""
    runs = run_folders(spark, path, newest_per_stamp)
    plain = [path] if not runs or data_files(spark, path) else []
    return spark.read.parquet(*plain, *runs)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    stamp: int = 0,
) -> dict[str, int]:
    """Replace the whole table at ``path``, one folder level per key.

    The whole table is replaced whatever overwrite mode the session has, and
    only once the new one is complete. ``rebalance`` brings a key's rows
    together, so that a folder gets few files, and lets AQE cut a hot key into
    partitions of advisory size.

    A folder name cannot tell ``''`` from NULL. The return value, counted in
    the writing tasks themselves, says how many blanks each key column lost.
    """

    def save(rows: DataFrame, folder: str) -> None:
        (
            rows.write.option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*keys)
            .parquet(folder)
        )

    blanks = {key: F.count_if(field(key).cast("string") == "") for key in keys}
    laid_out = df.hint("rebalance", *[field(key) for key in keys])
    return publish(laid_out, path, stamp, save, also=blanks)


def write_table(
    df: DataFrame,
    path: str,
    files: int | None = None,
    stamp: int = 0,
    accept: Callable[[int], None] | None = None,
) -> None:
    """Replace the table at ``path``, keeping the order of a sorted ``df``.

    Left to itself Spark writes one file per shuffle partition, which AQE has
    already merged: a small table is one file and a large one is many. A fixed
    number of ``files`` is for tables known to be small. ``accept`` is given the
    number of rows and may refuse them; the old table then stays.
    """
    laid_out = df if files is None else df.coalesce(files)
    publish(laid_out, path, stamp, _save_parquet, accept=accept)


def append_rows(df: DataFrame, path: str, stamp: int | None = None) -> None:
    """Append one run's few rows to a log table, in one file.

    Rows with a ``stamp`` replace those that were appended under it before, so
    that a run which is repeated counts once. Read them with ``read_rows``.
    """
    one_file = df.coalesce(1)
    if stamp is None:
        one_file.write.mode("append").parquet(path)
    else:
        publish(one_file, path, stamp, _save_parquet, newest_per_stamp)


def _save_parquet(rows: DataFrame, folder: str) -> None:
    rows.write.parquet(folder)
