"""Published runs: data goes to a new folder, and a record written last makes it count.

A run's files lie in ``_runs/<run folder>`` below the table's path, and the
records, one JSON line in a file of its own each, in ``_published/log``. A file
is there whole or not at all, so a reader sees a run with all its files or does
not see it: whoever is lost while writing leaves the rows that counted before.
A record names the run's folder, rows and files; readers hold the files against
it. Both folders are hidden from a plain read of the path.

A path has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = "_runs"
LOG = "_published/log"

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("stamp", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_files", T.LongType()),
    ]
)

# Runs of a replaced table that stay: the current one, and the one before for
# readers that opened it.
KEPT_RUNS = 2


class IncompleteRun(ValueError):
    """A published run has lost files, or has more than were published."""


@dataclass(frozen=True, order=True)
class Published:
    number: int
    stamp: int
    folder: str
    n_rows: int
    n_files: int


def run_records(spark: SparkSession, path: str) -> list[Published]:
    """All records of ``path``, oldest first; one per run."""
    log, files = _hadoop(spark, f"{path}/{LOG}")
    if not files.exists(log):
        return []
    rows = spark.read.schema(RECORD_SCHEMA).json(f"{path}/{LOG}").collect()
    return sorted(Published(*row) for row in rows)


def newest(records: list[Published]) -> list[Published]:
    """The run that counts where each replaces all before it."""
    return records[-1:]


def newest_per_stamp(records: list[Published]) -> list[Published]:
    """The runs that count where each replaces only those of its own stamp."""
    return list({record.stamp: record for record in records}.values())


def run_folders(
    spark: SparkSession, path: str, counted: Callable[[list[Published]], list[Published]]
) -> list[str]:
    """The folders of the runs that count, each with the files it was published with."""
    folders = []
    for record in counted(run_records(spark, path)):
        folder = f"{path}/{RUNS}/{record.folder}"
        found = len(data_files(spark, folder))
        if found != record.n_files:
            raise IncompleteRun(f"{folder} holds {found} files, published were {record.n_files}")
        folders.append(folder)
    return folders


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files below ``path``, hidden ones left out. Lists them and opens none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.inputFiles()


def publish(
    df: DataFrame,
    path: str,
    stamp: int,
    write: Callable[[DataFrame, str], None],
    replaces: Callable[[list[Published]], list[Published]] = newest,
    accept: Callable[[int], None] | None = None,
    also: Mapping[str, Column] | None = None,
) -> dict:
    """Write ``df`` to a new run folder, then its record, then drop what was replaced.

    ``write`` stores the frame it is given in the folder it is given.
    ``accept`` sees the number of rows before the record is written, and raises
    if they must not count. The aggregates ``also`` are taken by the writing
    tasks and returned.
    """
    spark = df.sparkSession
    before = run_records(spark, path)
    folder = f"run-{stamp}-{uuid.uuid4().hex}"
    target = f"{path}/{RUNS}/{folder}"
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *_named(also or {})), target)
    figures = dict(seen.get)
    n_rows = figures.pop("n_rows")
    if accept is not None:
        accept(n_rows)
    number = 1 + max((record.number for record in before), default=0)
    record = Published(number, stamp, folder, n_rows, len(data_files(spark, target)))
    line = spark.createDataFrame([astuple(record)], RECORD_SCHEMA).coalesce(1)
    line.write.mode("append").json(f"{path}/{LOG}")
    _drop_replaced(spark, path, [*before, record], stamp, replaces)
    return figures


def _named(aggregates: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in aggregates.items()]


def _drop_replaced(
    spark: SparkSession,
    path: str,
    records: list[Published],
    stamp: int,
    replaces: Callable[[list[Published]], list[Published]],
) -> None:
    """Delete run folders that no longer count, those of failed writes among them.

    Of a table that each run replaces, the run before stays too. Where stamps
    count apart, only folders of this stamp are looked at.
    """
    if replaces is newest:
        kept, looked_at = records[-KEPT_RUNS:], "run-"
    else:
        kept, looked_at = replaces(records), f"run-{stamp}-"
    names = {record.folder for record in kept}
    runs, files = _hadoop(spark, f"{path}/{RUNS}")
    for status in files.listStatus(runs):
        folder = status.getPath()
        if folder.getName().startswith(looked_at) and folder.getName() not in names:
            files.delete(folder, True)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """``path`` and its file system, as Hadoop objects."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())
