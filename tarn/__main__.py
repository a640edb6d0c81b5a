"""Run a layer from the command line: ``spark-submit`` this file, or ``python -m tarn``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tarn.functions import LAKE_ZONE, RunStamp
from tarn.operators import shape
from tarn.operators.gates import NOT_THERE
from tarn.plans import run_all, run_bronze, run_gold, run_silver
from tarn.plans.settings import scale_settings
from tarn.sources import LakePaths, listed_bytes, newest, newest_per_stamp, run_folders


def parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="tarn", description=__doc__)
    cli.add_argument("layer", choices=["bronze", "silver", "gold", "all"])
    cli.add_argument("--root", required=True, help="the lake's root folder")
    cli.add_argument("--table", default="breweries", help="the subject's folder name")
    cli.add_argument("--pages", help="folder of page files (bronze, all)")
    cli.add_argument("--fields", nargs="*", help="the record fields, if known")
    cli.add_argument(
        "--page-per-line", action="store_true", help="pages are stored one per line"
    )
    cli.add_argument(
        "--at", type=datetime.fromisoformat, help="the run's moment, with its zone; default now"
    )
    cli.add_argument("--zone", default=LAKE_ZONE, help="the lake's clock")
    cli.add_argument(
        "--input-bytes",
        type=int,
        help="size the session for this much input; default the layer's files as listed",
    )
    cli.add_argument("--approx", action="store_true", help="estimate the cardinalities")
    return cli


def size_session(
    spark: SparkSession, source: str | list[str], input_bytes: int | None
) -> None:
    """Apply the settings that depend on the size of the layer's input.

    A source that is not there is left to the layer's gate.
    """
    try:
        size = listed_bytes(spark, source) if input_bytes is None else input_bytes
    except AnalysisException as error:
        if error.getCondition() not in NOT_THERE:
            raise
        return
    for key, value in scale_settings(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def main(argv: Sequence[str] | None = None) -> None:
    cli = parser()
    args = cli.parse_args(argv)
    if args.layer in ("bronze", "all") and not args.pages:
        cli.error(f"{args.layer} needs --pages")
    spark = SparkSession.builder.appName(f"tarn {args.layer}").getOrCreate()
    run = RunStamp.at(args.at, args.zone) if args.at else RunStamp.now(args.zone)
    paths = LakePaths(args.root, args.table)
    source = args.pages
    if args.layer == "silver":
        month = paths.raw_month(run)
        source = [month, *run_folders(spark, month, newest_per_stamp)]
    elif args.layer == "gold":
        source = run_folders(spark, paths.silver, newest) or paths.silver
    size_session(spark, source, args.input_bytes)
    landing = (spark, args.pages, paths, run, args.fields, not args.page_per_line)
    if args.layer == "bronze":
        run_bronze(*landing)
        return
    if args.layer == "silver":
        stored = run_silver(spark, paths, run, args.approx)
    elif args.layer == "gold":
        stored = run_gold(spark, paths, run, args.approx)
    else:
        stored = run_all(*landing, args.approx)
    shape(stored.table).show()
    if stored.preview is not None:
        stored.preview.show(truncate=False)


if __name__ == "__main__":
    main()
