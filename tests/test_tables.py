from __future__ import annotations

import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import RunStamp
from tarn.sources import (
    LakePaths,
    append_rows,
    local_rows,
    read_rows,
    read_table,
    run_records,
    scratch_folder,
    write_partitioned,
    write_table,
)

KEYED = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in ("country", "state", "note")]
)


def parts(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_paths():
    paths = LakePaths("s3a://lake", "sites")
    run = RunStamp(20261231, 202612, 20261231235959)
    assert paths.raw_month(run) == "s3a://lake/raw/sites/2026-12"
    assert (paths.silver, paths.gold) == ("s3a://lake/silver/sites", "s3a://lake/gold/sites")
    assert paths.metadata("gold") == "s3a://lake/metadata/gold/sites"
    assert paths.control("silver") == "s3a://lake/control/silver/sites"


def test_scratch_folders_are_new_and_shared(spark):
    a, b = scratch_folder(spark), scratch_folder(spark)
    assert a != b and os.path.dirname(a) == os.path.dirname(b)
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or a.startswith(shared)


def test_a_cluster_must_name_its_shared_folder():
    def session(**settings):
        return SimpleNamespace(conf=settings)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session(**{"spark.master": "yarn"}))
    named = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://shared/"}
    assert scratch_folder(session(**named)).startswith("hdfs://shared/tarn-")
    assert scratch_folder(session(**{"spark.master": "local[2]"})).startswith("/")


def test_partition_values_survive(spark, tmp_path):
    rows = [
        (1, "A/B=c", "01", "n"),
        (2, "A/B=c", "1", "n"),
        (3, "São Tomé", "50%", "n"),
        (4, None, "x:y", "n"),
        (5, "", None, "n"),
        (6, "2024-01-01", "a b", ""),
    ]
    blanks = write_partitioned(
        spark.createDataFrame(rows, KEYED), str(tmp_path), ["country", "state"]
    )
    assert blanks == {"country": 1, "state": 0}
    back = read_table(spark, str(tmp_path), KEYED)
    assert back.schema == KEYED
    expected = [(i, c or None, s, n) for i, c, s, n in rows]
    assert sorted(tuple(r) for r in back.collect()) == expected


def test_overwrite_replaces_the_whole_table(spark, tmp_path):
    for rows in ([(1, "a", "x", "n"), (2, "b", "y", "n")], [(3, "a", "x", "n")]):
        df = spark.createDataFrame(rows, KEYED)
        write_partitioned(df, str(tmp_path), ["country", "state"])
    assert read_table(spark, str(tmp_path), KEYED).collect() == [(3, "a", "x", "n")]


def test_a_filter_on_a_key_reads_only_its_folders(spark, tmp_path):
    df = spark.range(100).selectExpr(
        "id", "concat('c', id % 5) AS country", "concat('s', id % 3) AS state", "'n' AS note"
    )
    write_partitioned(df, str(tmp_path), ["country", "state"])
    one = read_table(spark, str(tmp_path), KEYED).filter("country = 'c1'").select("id", "country")
    assert one.count() == 20
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(country" in plan
    assert "ReadSchema: struct<id:bigint>" in plan
    assert sum("country=c1" in f for f in one.inputFiles()) > 0


def test_a_hot_key_is_written_by_many_tasks(spark, tmp_path):
    """A third of all rows under one key must not become one task's work."""
    df = spark.range(0, 300_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))
        ).alias("country"),
        F.lit("s").alias("state"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        write_partitioned(df, str(tmp_path), ["country", "state"])
    finally:
        spark.conf.set(name, before)
    assert len(parts(tmp_path / "_runs/*/country=hot")) > 3
    assert len(parts(tmp_path / "_runs/*/country=c1")) <= 2
    back = read_table(spark, str(tmp_path), KEYED)
    assert back.count() == back.select("id").distinct().count() == 300_000


def test_a_small_sorted_table_is_one_file_in_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).orderBy(F.desc("id"))
    write_table(df, str(tmp_path / "left"))
    write_table(df, str(tmp_path / "one"), files=1)
    for name in ("left", "one"):
        (part,) = parts(tmp_path / name)
        ids = [r.id for r in spark.read.parquet(part).collect()]
        assert ids == list(range(999, -1, -1))


def test_overwrite_replaces_the_whole_table_in_a_dynamic_session(spark, tmp_path):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    old = spark.createDataFrame([(1, "old", "s", "n")], KEYED)
    new = spark.createDataFrame([(2, "new", "s", "n")], KEYED)
    spark.conf.set(name, "dynamic")
    try:
        write_partitioned(old, str(tmp_path), ["country", "state"])
        write_partitioned(new, str(tmp_path), ["country", "state"])
    finally:
        spark.conf.set(name, before)
    assert [r.id for r in read_table(spark, str(tmp_path), KEYED).collect()] == [2]


def test_append_keeps_both_copies(spark, tmp_path):
    row = local_rows(spark, [("t", 1)], T.StructType.fromDDL("name string, n long"))
    append_rows(row, str(tmp_path))
    append_rows(row, str(tmp_path))
    assert len(parts(tmp_path)) == 2
    assert spark.read.parquet(str(tmp_path)).collect() == [("t", 1), ("t", 1)]


def test_local_rows_keep_the_schema_and_their_size(spark):
    schema = T.StructType(
        [T.StructField("a", T.StringType(), False), T.StructField("n", T.LongType())]
    )
    df = local_rows(spark, [("x", None), ("y", 2)], schema)
    assert df.schema == schema
    assert df.collect() == [("x", None), ("y", 2)]
    assert "LocalTableScan" in plan_of(df)
    with pytest.raises(ValueError):
        local_rows(spark, [("x",)], schema)


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path, partitioned):
    """The failing column is computed by the writing tasks, after the shuffle."""
    path, keys = str(tmp_path), ["country", "state"]

    def write(df):
        if partitioned:
            write_partitioned(df, path, keys, stamp=2)
        else:
            write_table(df, path, stamp=2)

    old = [(1, "a", "x", "n"), (2, "b", "y", "n")]
    write(spark.createDataFrame(old, KEYED))
    lost = spark.range(100).selectExpr("id", "concat('c', id % 3) AS country", "'s' AS state")
    failing = F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.lit("n"))
    lost = lost.repartition(4, "country").withColumn("note", failing)
    with pytest.raises(Exception, match="lost"):
        write(lost)
    assert sorted(map(tuple, read_table(spark, path, KEYED).collect())) == old
    write(spark.createDataFrame([(3, "a", "x", "n")], KEYED))
    assert read_table(spark, path, KEYED).collect() == [(3, "a", "x", "n")]


def test_a_driver_lost_before_the_record_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    """All files of the new run are there; only its record is not."""
    import tarn.sources.published as module

    path = str(tmp_path)
    write_table(spark.range(5), path)
    monkeypatch.setattr(module, "astuple", lambda record: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_table(spark.range(9), path)
    monkeypatch.undo()
    assert len(os.listdir(f"{path}/_runs")) == 2
    assert read_table(spark, path).count() == 5


def test_the_run_before_stays_for_its_readers(spark, tmp_path):
    path = str(tmp_path)
    frames = []
    for rows in (1, 2, 3):
        write_table(spark.range(rows), path, stamp=rows)
        frames.append(read_table(spark, path))
    assert frames[1].count() == 2 and frames[2].count() == 3
    assert len(os.listdir(f"{path}/_runs")) == 2
    records = run_records(spark, path)
    assert [(r.number, r.stamp, r.n_rows) for r in records] == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]


def test_rows_of_a_stamp_are_appended_once(spark, tmp_path):
    path, schema = str(tmp_path), T.StructType.fromDDL("name string, n long")
    append_rows(local_rows(spark, [("plain", 0)], schema), path)
    for stamp, n in ((1, 1), (2, 2), (1, 3)):
        append_rows(local_rows(spark, [("t", n)], schema), path, stamp)
    assert sorted(map(tuple, read_rows(spark, path).collect())) == [
        ("plain", 0), ("t", 2), ("t", 3),
    ]


def test_a_table_written_by_others_is_read_as_it_is(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 3
    assert read_rows(spark, str(tmp_path / "plain")).count() == 3


def test_an_empty_table_is_published_unless_refused(spark, tmp_path):
    path = str(tmp_path)
    write_table(spark.range(3), path)

    def refuse(rows):
        if not rows:
            raise ValueError("empty")

    with pytest.raises(ValueError, match="empty"):
        write_table(spark.range(0), path, accept=refuse)
    assert read_table(spark, path).count() == 3
    write_table(spark.range(0), path)
    assert read_table(spark, path).count() == 0
