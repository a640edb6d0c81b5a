"""The jobs: land Bronze, build Silver, build Gold, or all three in a chain.

No job caches its table. Each writes it first and takes the profile, the
catalogue and the control from the written Parquet: what is stored survives
lost executors, and only the columns asked for are read back.

All that a job stores carries its run's stamp. A job that is repeated under one
stamp replaces what it stored before; its control rows come last, so their
record says that the layer is complete.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tarn.functions import RunStamp
from tarn.operators import (
    catalogue,
    conform,
    count_by,
    dictionary,
    normalize,
    profile,
    ranked,
    require_count,
    require_layer,
    require_rows,
    stamped,
    structure,
    top,
    volume,
)
from tarn.plans import layout
from tarn.sources import (
    LakePaths,
    append_rows,
    land_month,
    newest,
    newest_per_stamp,
    read_month,
    read_pages,
    read_table,
    run_records,
    write_partitioned,
    write_table,
)


@dataclass(frozen=True)
class LayerRun:
    """What a job stored: the table, and for Gold its first rows."""

    table: DataFrame
    preview: DataFrame | None = None


def run_bronze(
    spark: SparkSession,
    pages: str | list[str],
    paths: LakePaths,
    run: RunStamp,
    fields: Sequence[str] | None = None,
    one_page_per_file: bool = True,
) -> None:
    """Land the records of the page files in the run's month folder.

    A landing that is repeated under one stamp takes the place of the first.
    """
    records = require_layer(
        lambda: read_pages(spark, pages, fields, one_page_per_file), "the source pages"
    )
    cells = normalize(records, layout.BRONZE_COLUMNS, layout.COORDINATES)
    land_month(cells, paths.raw_month(run), layout.BRONZE_COLUMNS, stamp=run.ts_proc)


def run_silver(
    spark: SparkSession, paths: LakePaths, run: RunStamp, approx: bool = False
) -> LayerRun:
    """Build Silver from the run's Bronze month, replacing the table."""
    month = require_layer(
        lambda: read_month(spark, paths.raw_month(run)), f"Bronze, month {run.month}"
    )
    rows = conform(month, layout.BRONZE_COLUMNS, layout.COORDINATES, run)
    require_rows(rows, "Silver, before the write")
    blanks = write_partitioned(rows, paths.silver, layout.SILVER_KEYS, stamp=run.ts_proc)
    silver = read_table(spark, paths.silver, layout.SILVER_SCHEMA)
    write_table(
        catalogue(
            structure(silver, layout.SILVER_TABLE, "silver"),
            dictionary(spark, layout.SILVER_DICTIONARY),
            profile(silver, approx=approx, blank_keys=blanks, isolate=True),
        ),
        paths.metadata("silver"),
        files=1,
        stamp=run.ts_proc,
    )
    append_rows(
        volume(silver, layout.SILVER_TABLE, layout.SILVER_STAMPS),
        paths.control("silver"),
        run.ts_proc,
    )
    return LayerRun(silver)


def run_gold(
    spark: SparkSession,
    paths: LakePaths,
    run: RunStamp,
    approx: bool = False,
    files: int | None = None,
) -> LayerRun:
    """Build Gold from Silver, replacing the table.

    The writing tasks count the rows, and the gate looks at the count before
    the new table takes the old one's place.
    """
    silver = require_layer(
        lambda: read_table(spark, paths.silver, layout.SILVER_SCHEMA), "Silver"
    )
    counts = stamped(count_by(silver, layout.GOLD_KEYS, layout.GOLD_COUNT), run)
    write_table(
        ranked(counts, layout.GOLD_COUNT, layout.GOLD_KEYS),
        paths.gold,
        files,
        stamp=run.ts_proc,
        accept=lambda rows: require_count(rows, "Gold, before the write"),
    )
    gold = read_table(spark, paths.gold, layout.GOLD_SCHEMA)
    write_table(
        catalogue(
            structure(gold, layout.GOLD_TABLE, "gold"),
            dictionary(spark, layout.GOLD_DICTIONARY),
            profile(gold, approx=approx, isolate=True),
        ),
        paths.metadata("gold"),
        files=1,
        stamp=run.ts_proc,
    )
    append_rows(
        volume(gold, layout.GOLD_TABLE, layout.GOLD_STAMPS), paths.control("gold"), run.ts_proc
    )
    return LayerRun(gold, top(gold, layout.GOLD_COUNT, layout.GOLD_KEYS))


def completed(spark: SparkSession, paths: LakePaths, run: RunStamp) -> list[str]:
    """The layers that this run has stored whole, up to the first it has not.

    A layer is whole when its last record, that of the control, is there, and it
    is the run's as long as no other run has replaced its table.
    """

    def stamps(path: str, counted) -> set[int]:
        return {record.stamp for record in counted(run_records(spark, path))}

    landed = {"bronze": [(paths.raw_month(run), newest_per_stamp)]}
    built = {
        zone: [(paths.control(zone), newest_per_stamp), (getattr(paths, zone), newest)]
        for zone in ("silver", "gold")
    }
    whole = []
    for layer, records in {**landed, **built}.items():
        if not all(run.ts_proc in stamps(path, counted) for path, counted in records):
            break
        whole.append(layer)
    return whole


def run_all(
    spark: SparkSession,
    pages: str | list[str],
    paths: LakePaths,
    run: RunStamp,
    fields: Sequence[str] | None = None,
    one_page_per_file: bool = True,
    approx: bool = False,
) -> LayerRun:
    """Bronze, Silver and Gold in turn; the first layer found empty stops it.

    Called again under the same stamp after a failure, it goes on at the first
    layer that the run has not stored whole.
    """
    done = completed(spark, paths, run)
    if "bronze" not in done:
        run_bronze(spark, pages, paths, run, fields, one_page_per_file)
    if "silver" not in done:
        run_silver(spark, paths, run, approx)
    if "gold" not in done:
        run_gold(spark, paths, run, approx)
    gold = require_layer(lambda: read_table(spark, paths.gold, layout.GOLD_SCHEMA), "Gold")
    return LayerRun(gold, top(gold, layout.GOLD_COUNT, layout.GOLD_KEYS))
