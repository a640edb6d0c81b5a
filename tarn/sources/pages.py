"""Reading landed page files of JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    fields: Sequence[str] | None = None,
    one_page_per_file: bool = True,
) -> DataFrame:
    """All records of all pages as one bag; every primitive arrives as text.

    A page is a JSON array of records, and an empty page adds no rows. One bad
    page fails the whole read: there is no partial result.

    ``fields`` names the record fields. Left out, Spark finds them, so that
    unknown ones survive, at the price of one more pass over the pages. Named,
    the pages are read once, and a record with another field fails the read:
    no field is ever dropped. Numbers then come in the form JSON gives them when
    it writes them again (``3.10`` as ``3.1``).

    With ``one_page_per_file`` a page may spread over lines, and a file is read
    by one task. Pages written one per line are read with ``False``: any number
    may share a file, and Spark splits large files between tasks.
    """
    if fields is not None:
        return _named(spark, path, list(fields), one_page_per_file)
    return (
        spark.read.option("multiLine", one_page_per_file)
        .option("primitivesAsString", True)
        .option("mode", "FAILFAST")
        .json(path)
    )


def _named(spark: SparkSession, path: str | list[str], fields: list[str], whole: bool) -> DataFrame:
    page = F.regexp_replace("value", r"^\s+", "")
    records = F.from_json(
        # A page may also be a single record.
        F.when(page.startswith("{"), F.concat(F.lit("["), page, F.lit("]"))).otherwise(page),
        "array<map<string,string>>",
        {"mode": "FAILFAST"},
    )
    record = F.col("record")
    pages = spark.read.text(path, wholetext=whole).where(page != "")
    return pages.select(F.explode(records).alias("record")).select(
        *[_only_named(record, fields)[name].alias(name) for name in fields]
    )


def _only_named(record: Column, fields: list[str]) -> Column:
    """The record, or an error that names its other fields."""
    others = F.array_except(F.map_keys(record), F.array(*[F.lit(name) for name in fields]))
    message = F.concat(F.lit("fields that were not named: "), F.array_join(others, ", "))
    return F.when(F.size(others) > 0, F.raise_error(message)).otherwise(record)
