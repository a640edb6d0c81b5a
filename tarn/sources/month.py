"""The Bronze month: CSV files with a header, appended run by run.

A landing under a run stamp is published (``tarn.sources.published``): it counts
once it is complete, and a repeated one takes the place of the first.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import field
from tarn.sources.published import newest_per_stamp, publish, run_folders

# Quotes are doubled inside quoted cells, and cells may hold line breaks. Left to
# its default, NUL, the escape of the escape would drop NULs next to quotes.
DIALECT = {"header": True, "escape": '"', "charToEscapeQuoteEscaping": '"', "lineSep": "\n"}

# Cells with line breaks make a CSV file unsplittable, so one task reads one
# file whole: bound the file, not the reader, by records and by bytes.
MAX_RECORDS_PER_FILE = 1_000_000
MAX_BYTES_PER_FILE = 512 * 1024 * 1024
# Rows from whose mean length the records that fill a file are reckoned.
MEASURED_ROWS = 10_000


def land_month(
    df: DataFrame,
    path: str,
    known: Sequence[str],
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    max_bytes_per_file: int = MAX_BYTES_PER_FILE,
    compression: str = "none",
    stamp: int | None = None,
) -> None:
    """Append ``df`` to the month folder ``path``.

    With a ``stamp`` it replaces what landed under the same stamp before, and
    nothing else.

    The ``known`` columns come first, in that order and blank where absent, and
    the others follow by name. Rows with others go to a folder of their own
    inside the month, one per set of names, so the files of a folder share one
    header. Nested cells are written as JSON text. Spark names the files,
    uniquely. Names that differ only by case are refused before anything is
    written: no header with them could be read again.

    A file holds at most ``max_records_per_file`` records, and fewer where the
    mean length of the first rows says that they would exceed
    ``max_bytes_per_file``.
    """
    names = Counter(name.lower() for name in {*known, *df.columns})
    clashes = sorted(name for name, n in names.items() if n > 1)
    if clashes:
        raise ValueError(f"column names that differ only by case: {', '.join(clashes)}")
    extras = sorted(name for name in df.columns if name not in known)
    cells = [
        field(name).alias(name) if name in df.columns else F.lit(None).cast("string").alias(name)
        for name in known
    ]
    for name in extras:
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
        cells.append((F.to_json(field(name)) if nested else field(name)).alias(name))
    rows = df.select(*cells)
    records = min(max_records_per_file, _fitting(rows, max_bytes_per_file))

    def save(cells: DataFrame, folder: str) -> None:
        (
            cells.write.mode("append")
            .options(**DIALECT)
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("maxRecordsPerFile", records)
            .option("compression", compression)
            .csv(f"{folder}/{_header_folder(extras)}" if extras else folder)
        )

    if stamp is None:
        save(rows, path)
    else:
        publish(rows, path, stamp, save, newest_per_stamp)


def _fitting(rows: DataFrame, max_bytes: int) -> int:
    """How many records of the mean length of the first rows make ``max_bytes``."""
    lengths = [
        F.coalesce(F.octet_length(field(name).cast("string")), F.lit(0)) for name in rows.columns
    ]
    width = reduce(lambda a, b: a + b, lengths) + len(lengths)
    mean = rows.select(width.alias("width")).limit(MEASURED_ROWS).agg(F.avg("width")).first()[0]
    return max(1, int(max_bytes / (mean or 1)))


def read_month(spark: SparkSession, path: str) -> DataFrame:
    """Every file of the month as one table of text columns; blanks are NULL.

    All files count, whatever their names and compression, and they are matched
    by column name. Spark reads CSV by position, so the
    header of a folder is read first and then required of all its files: one
    whose columns differ fails the read instead of filling the wrong columns,
    and so does a row with more or fewer cells than its header. Of landings
    under one stamp the last complete one counts, and it must have all its files.
    """
    landings = [path, *run_folders(spark, path, newest_per_stamp)]
    folders = [_read_folder(spark, folder) for folder in _folders(spark, landings) or [path]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), folders)


def _header_folder(extras: Sequence[str]) -> str:
    return "fields-" + hashlib.sha256("\n".join(extras).encode()).hexdigest()[:16]


def _folders(spark: SparkSession, paths: list[str]) -> list[str]:
    """The folders that hold files. Lists names only and opens no file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(paths)
    )
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return sorted(row.folder for row in files.select(folder).distinct().collect())


def _read_folder(spark: SparkSession, folder: str) -> DataFrame:
    header = spark.read.options(**DIALECT).option("multiLine", True).csv(folder).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return (
        spark.read.options(**DIALECT)
        .option("multiLine", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        # Cells are counted only where all of them are parsed.
        .option("columnPruning", False)
        .schema(schema)
        .csv(folder)
    )
