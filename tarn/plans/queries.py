"""The operators as queries over the star-schema test tables.

``site_raw`` gives customers the shape of raw records, with padding, NULLs,
blanks, bad numbers, quotes and line breaks put in by key. All queries use one
fixed run stamp, and those that write do so in a new folder that all executors
share.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import RunStamp, render_stamp
from tarn.operators import (
    EmptyLayer,
    catalogue,
    conform,
    count_by,
    count_by_sql,
    dictionary,
    normalize,
    profile,
    ranked,
    require_layer,
    require_rows,
    shape,
    stamped,
    structure,
    top,
    volume,
)
from tarn.plans import layout
from tarn.plans.layers import run_all, run_bronze, run_gold, run_silver
from tarn.sources import (
    LakePaths,
    append_rows,
    land_month,
    local_rows,
    read_month,
    read_pages,
    read_rows,
    read_table,
    scratch_folder,
    write_partitioned,
    write_table,
)

RUN = RunStamp(ref=20260115, ref_partition=202601, ts_proc=20260115060000)
NEXT_RUN = RunStamp(ref=20260116, ref_partition=202601, ts_proc=20260116060000)

# Records of a page, the source's own page size.
PAGE_RECORDS = 200

PROFILED_TABLES = [
    "customer",
    "orders",
    "lineitem",
    "part",
    "events",
    "documents",
    "embeddings",
    "pages",
    "conversations",
    "labels",
]

# Relative error that an estimated cardinality is held to: four times the
# standard deviation of the estimator.
APPROX_ERROR = 0.2

OUTCOME_SCHEMA = T.StructType(
    [T.StructField("layer", T.StringType()), T.StructField("outcome", T.StringType())]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw records: the 16 known columns and an unknown one."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    number = key.cast("string")

    def every(n: int, then: str | None, otherwise: Column | None = None) -> Column:
        return F.when(key % n == 0, F.lit(then)).otherwise(otherwise).cast("string")

    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.concat(F.lit("  "), number, F.lit(" ")).alias("id"),
            F.concat(F.lit(" "), "c_name").alias("name"),
            F.concat("c_mktsegment", F.lit("  ")).alias("brewery_type"),
            every(9, "None", F.concat(number, F.lit(' Main St, "B" '))).alias("address_1"),
            every(17, "line1\nline2").alias("address_2"),
            F.lit(None).cast("string").alias("address_3"),
            every(
                7, None, F.concat(F.lit(" City "), (key % 40).cast("string"))
            ).alias("city"),
            F.col("n_name").alias("state_province"),
            F.lpad((key % 1000).cast("string"), 5, "0").alias("postal_code"),
            every(11, None, F.col("r_name")).alias("country"),
            every(13, "bad", F.col("c_acctbal").cast("string")).alias("longitude"),
            F.concat(F.lit(" "), (key % 90).cast("string"), F.lit(".25 ")).alias("latitude"),
            every(19, "   ").alias("phone"),
            F.concat(F.lit("\thttp://"), number, F.lit(".example\u00a0 ")).alias("website_url"),
            every(23, "  ", F.col("n_name")).alias("state"),
            F.concat("n_name", F.lit("/"), "r_name").alias("street"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw records: whole texts with quotes, tabs and line breaks."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("name"),
        F.col("lang").alias("brewery_type"),
        F.col("source").alias("city"),
        "n_chars",
    )


def _bronze(df: DataFrame) -> DataFrame:
    return normalize(df, layout.BRONZE_COLUMNS, layout.COORDINATES)


def _silver(spark: SparkSession, sf_dir: str, run: RunStamp = RUN) -> DataFrame:
    return conform(
        site_raw(spark, sf_dir), layout.BRONZE_COLUMNS, layout.COORDINATES, run
    )


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    return stamped(count_by(silver, layout.GOLD_KEYS, layout.GOLD_COUNT), RUN)


def _write_pages(records: DataFrame, path: str) -> None:
    """Files of one page per line: pages of 200 records, the last of a task
    fewer, and one of none."""
    number = F.floor(F.monotonically_increasing_id() / PAGE_RECORDS)
    pages = (
        records.withColumn("page", number)
        .groupBy("page")
        .agg(F.collect_list(F.struct(*records.columns)).alias("records"))
        .select(F.to_json("records", {"ignoreNullFields": "false"}).alias("value"))
    )
    empty = records.sparkSession.range(1).select(F.lit("[]").alias("value"))
    pages.union(empty).write.text(path)


def bronze_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(site_raw(spark, sf_dir))


def bronze_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    _write_pages(site_raw(spark, sf_dir), folder)
    return read_pages(spark, folder, one_page_per_file=False)


def _month_roundtrip(spark: SparkSession, records: DataFrame) -> DataFrame:
    month = LakePaths(scratch_folder(spark)).raw_month(RUN)
    land_month(_bronze(records), month, layout.BRONZE_COLUMNS)
    return read_month(spark, month)


def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a month: one compressed and one with an unknown field."""
    month = LakePaths(scratch_folder(spark)).raw_month(RUN)
    records = _bronze(site_raw(spark, sf_dir))
    odd = F.regexp_extract("id", "[0-9]+", 0).cast("bigint") % 2 == 1
    land_month(records.where(odd), month, layout.BRONZE_COLUMNS)
    plain = records.where(~odd).drop("segment")
    land_month(plain, month, layout.BRONZE_COLUMNS, compression="gzip")
    landed = read_month(spark, month)
    coordinates = {name: landed[name].try_cast("double") for name in layout.COORDINATES}
    return landed.withColumns(coordinates)


def bronze_documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _month_roundtrip(spark, document_records(spark, sf_dir))
    return landed.select("id", "name", "brewery_type", "city", "state", "n_chars")


def silver_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = document_records(spark, sf_dir)
    return conform(records, ["id", "name", "brewery_type", "city", "n_chars"], ["n_chars"], RUN)


def silver_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = LakePaths(scratch_folder(spark)).silver
    write_partitioned(_silver(spark, sf_dir), path, layout.SILVER_KEYS)
    return read_table(spark, path, layout.SILVER_SCHEMA)


def gold_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = require_rows(_silver(spark, sf_dir), "Silver")
    counts = stamped(count_by(silver, layout.GOLD_KEYS, layout.GOLD_COUNT), RUN)
    return ranked(counts, layout.GOLD_COUNT, layout.GOLD_KEYS)


def gold_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(_gold(spark, sf_dir), layout.GOLD_COUNT, layout.GOLD_KEYS)


def gold_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = LakePaths(scratch_folder(spark)).gold
    write_table(ranked(_gold(spark, sf_dir), layout.GOLD_COUNT, layout.GOLD_KEYS), path)
    return read_table(spark, path, layout.GOLD_SCHEMA)


def sql_args_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_sql(_silver(spark, sf_dir), layout.GOLD_KEYS, layout.GOLD_COUNT, RUN)


def rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_shipdate", "l_returnflag", "l_linestatus"]
    counts = count_by(table(spark, sf_dir, "lineitem"), keys, "line_count")
    return ranked(counts, "line_count", keys)


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a stored table: a profile reads its input several times."""
    path = LakePaths(scratch_folder(spark)).silver
    write_table(_silver(spark, sf_dir), path)
    return read_table(spark, path, layout.SILVER_SCHEMA)


def profile_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(_stored_silver(spark, sf_dir))


def profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimated profile, with whether each estimate is near the exact count."""
    lines = table(spark, sf_dir, "lineitem")
    exact = profile(lines).select("coluna", F.col("cardinalidade").alias("exact"))
    error = F.abs(F.col("cardinalidade") - F.col("exact")) / F.col("exact")
    return (
        profile(lines, approx=True)
        .join(exact, "coluna")
        .select(
            "coluna", "tipo", "qt_nulos", "percent_nulos", (error <= APPROX_ERROR).alias("near_exact")
        )
    )


def _profile_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: profile(table(spark, sf_dir, name))


def profile_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with two columns that fail at run time: the others keep their figures."""
    lines = table(spark, sf_dir, "lineitem")
    broken = F.when(F.col("l_linenumber") > 1, F.raise_error(F.lit("unreadable")))
    views = {
        "l_broken": broken.otherwise(F.col("l_linenumber")).cast("int"),
        "l_flag_number": F.col("l_returnflag").cast("int"),
    }
    return profile(lines.withColumns(views), isolate=True)


def metadata_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _stored_silver(spark, sf_dir)
    return catalogue(
        structure(silver, layout.SILVER_TABLE, "silver"),
        dictionary(spark, layout.SILVER_DICTIONARY),
        profile(silver),
    )


def metadata_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_write_roundtrip(spark, sf_dir)
    return catalogue(
        structure(gold, layout.GOLD_TABLE, "gold"),
        dictionary(spark, layout.GOLD_DICTIONARY),
        profile(gold),
    )


def metadata_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose dictionary describes only some columns, in another case."""
    lines = table(spark, sf_dir, "lineitem")
    return catalogue(
        structure(lines, "lineitem", "source"),
        dictionary(spark, [("L_ORDERKEY", "order"), ("l_tax", "tax"), ("l_gone", "none")]),
        profile(lines),
    )


def control_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume(_silver(spark, sf_dir), layout.SILVER_TABLE, layout.SILVER_STAMPS)


def control_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume(_gold(spark, sf_dir), layout.GOLD_TABLE, layout.GOLD_STAMPS)


def control_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, of which the first is repeated after the second."""
    path = LakePaths(scratch_folder(spark)).control("silver")
    for run in (RUN, NEXT_RUN, RUN):
        rows = _silver(spark, sf_dir, run)
        append_rows(
            volume(rows, layout.SILVER_TABLE, layout.SILVER_STAMPS), path, stamp=run.ts_proc
        )
    return read_rows(spark, path)


def layer_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(_silver(spark, sf_dir))


def gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gates say of a full, an emptied and a missing layer."""
    layers = {
        "lineitem": lambda: table(spark, sf_dir, "lineitem"),
        "returned before sold": lambda: table(spark, sf_dir, "lineitem").filter("l_quantity < 0"),
        "not landed": lambda: table(spark, sf_dir, "not_landed"),
    }
    rows = []
    for name, open_layer in layers.items():
        try:
            require_layer(open_layer, name)
            rows.append((name, "open"))
        except EmptyLayer as stop:
            rows.append((name, str(stop)))
    return local_rows(spark, rows, OUTCOME_SCHEMA)


def run_stamp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stamps(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")


def run_stamp_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stamps(table(spark, sf_dir, "events"), "event_id", "ts")


def _run_stamps(df: DataFrame, key: str, moment: str) -> DataFrame:
    return df.select(
        key,
        render_stamp(F.col(moment)).cast("bigint").alias("ts_proc"),
        render_stamp(F.col(moment), "yyyyMMdd").cast("int").alias("ref"),
        render_stamp(F.col(moment), "yyyyMM").cast("int").alias("ref_partition"),
    )


def _chain(spark: SparkSession, sf_dir: str) -> LakePaths:
    pages, paths, fields = _inbox(spark, sf_dir)
    run_all(spark, pages, paths, RUN, fields=fields, one_page_per_file=False)
    return paths


def _inbox(spark: SparkSession, sf_dir: str) -> tuple[str, LakePaths, list[str]]:
    """The raw records as page files, beside a lake that is still empty."""
    folder = scratch_folder(spark)
    records = site_raw(spark, sf_dir)
    _write_pages(records, f"{folder}/pages")
    return f"{folder}/pages", LakePaths(f"{folder}/lake"), records.columns


def _retried_chain(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A run whose landing is repeated, whose Gold fails once, and that is then
    started again, twice."""
    pages, paths, fields = _inbox(spark, sf_dir)
    landing = {"fields": fields, "one_page_per_file": False}
    for _ in range(2):
        run_bronze(spark, pages, paths, RUN, **landing)
    run_silver(spark, paths, RUN)
    # Spark refuses to write a table in no files.
    with suppress(IllegalArgumentException):
        run_gold(spark, paths, RUN, files=0)
    for _ in range(2):
        run_all(spark, pages, paths, RUN, **landing)
    return paths


def chain_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _chain(spark, sf_dir).silver, layout.SILVER_SCHEMA)


def chain_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _chain(spark, sf_dir).gold, layout.GOLD_SCHEMA)


def _catalogues(spark: SparkSession, paths: LakePaths) -> DataFrame:
    silver, gold = (read_table(spark, paths.metadata(zone)) for zone in ("silver", "gold"))
    return silver.unionByName(gold)


def _controls(spark: SparkSession, paths: LakePaths) -> DataFrame:
    silver, gold = (read_rows(spark, paths.control(zone)) for zone in ("silver", "gold"))
    return silver.unionByName(gold, allowMissingColumns=True)


def chain_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalogues(spark, _chain(spark, sf_dir))


def chain_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _controls(spark, _chain(spark, sf_dir))


def retry_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _retried_chain(spark, sf_dir).gold, layout.GOLD_SCHEMA)


def retry_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _controls(spark, _retried_chain(spark, sf_dir))


def landing_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of two runs, of which the first lands again after the second."""
    month = LakePaths(scratch_folder(spark)).raw_month(RUN)
    records = _bronze(document_records(spark, sf_dir))
    for run, parity in ((RUN, 0), (NEXT_RUN, 1), (RUN, 0)):
        half = records.where(F.col("id").cast("bigint") % 2 == parity)
        land_month(half, month, layout.BRONZE_COLUMNS, stamp=run.ts_proc)
    landed = read_month(spark, month)
    return landed.select("id", "name", "brewery_type", "city", "state", "n_chars")


def replaced_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of one run, replaced by that of the next."""
    path = LakePaths(scratch_folder(spark)).silver
    for run in (RUN, NEXT_RUN):
        rows = _silver(spark, sf_dir, run)
        write_partitioned(rows, path, layout.SILVER_KEYS, stamp=run.ts_proc)
    return read_table(spark, path, layout.SILVER_SCHEMA)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_normalize": bronze_normalize,
    "bronze_json_pages": bronze_json_pages,
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "bronze_documents_roundtrip": bronze_documents_roundtrip,
    "silver_conform": silver_conform,
    "silver_documents": silver_documents,
    "silver_partition_roundtrip": silver_partition_roundtrip,
    "gold_rollup": gold_rollup,
    "gold_preview": gold_preview,
    "gold_write_roundtrip": gold_write_roundtrip,
    "sql_args_rollup": sql_args_rollup,
    "rollup_lineitem": rollup_lineitem,
    "profile_site": profile_site,
    "profile_approx": profile_approx,
    **{f"profile_{name}": _profile_table(name) for name in PROFILED_TABLES},
    "profile_broken": profile_broken,
    "metadata_silver": metadata_silver,
    "metadata_gold": metadata_gold,
    "metadata_lineitem": metadata_lineitem,
    "control_silver": control_silver,
    "control_gold": control_gold,
    "control_append": control_append,
    "layer_shape": layer_shape,
    "gate_outcomes": gate_outcomes,
    "run_stamp_orders": run_stamp_orders,
    "run_stamp_events": run_stamp_events,
    "chain_silver": chain_silver,
    "chain_gold": chain_gold,
    "chain_catalogue": chain_catalogue,
    "chain_control": chain_control,
    "retry_gold": retry_gold,
    "retry_control": retry_control,
    "landing_retry": landing_retry,
    "replaced_silver": replaced_silver,
}
