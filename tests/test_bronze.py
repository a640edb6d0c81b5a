from __future__ import annotations

import glob
import gzip
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError

from golden import BRONZE_CSV, FIELDS, RECORDS, RUN, write_page
from tarn.operators import EmptyLayer, normalize
from tarn.plans import layout, run_bronze
from tarn.sources import LakePaths, land_month, read_month, read_pages


def bronze(df):
    return normalize(df, layout.BRONZE_COLUMNS, layout.COORDINATES)


def csv_files(path):
    return glob.glob(f"{path}/**/*.csv", recursive=True)


def test_pages_are_one_bag_of_text(spark, tmp_path):
    write_page(tmp_path, "1.json", [{"id": "a", "n": 3.10, "b": True}, {"id": "a"}])
    write_page(tmp_path, "2.json", [{"id": "a", "extra": None}, {"id": "c", "extra": "e"}])
    write_page(tmp_path, "3.json", [])
    rows = read_pages(spark, str(tmp_path))
    assert dict(rows.dtypes) == dict.fromkeys(["id", "n", "b", "extra"], "string")
    assert sorted(r.id for r in rows.collect()) == ["a", "a", "a", "c"]
    # Primitives keep their text; json.dump itself writes 3.10 as 3.1.
    assert {(r.n, r.b) for r in rows.collect()} == {("3.1", "true"), (None, None)}


def test_pages_on_lines_share_a_file(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"id":"a"},{"id":"b"}]\n[]\n[{"id":"c","x":"y"}]\n')
    rows = read_pages(spark, str(tmp_path), one_page_per_file=False)
    assert sorted((r.id, r.x) for r in rows.collect()) == [("a", None), ("b", None), ("c", "y")]


def test_named_fields_save_the_discovery(spark, tmp_path):
    write_page(tmp_path, "1.json", [{"id": "a", "n": 1, "b": True, "nil": None}, {"id": "b"}])
    write_page(tmp_path, "2.json", [])
    rows = read_pages(spark, str(tmp_path), fields=["id", "n", "b", "nil", "absent"])
    assert dict(rows.dtypes) == dict.fromkeys(["id", "n", "b", "nil", "absent"], "string")
    assert sorted(rows.collect()) == [("a", "1", "true", None, None), ("b", None, None, None, None)]


def test_a_field_that_was_not_named_fails_the_read(spark, tmp_path):
    write_page(tmp_path, "1.json", [{"id": "a"}, {"id": "b", "unknown": 1}])
    with pytest.raises(Exception, match="fields that were not named: unknown"):
        read_pages(spark, str(tmp_path), fields=["id"]).collect()


def test_a_bad_page_of_named_fields_fails_the_read(spark, tmp_path):
    (tmp_path / "2.json").write_text('[{"id": "b"')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_pages(spark, str(tmp_path), fields=["id"]).collect()


def test_a_bad_page_fails_the_read(spark, tmp_path):
    write_page(tmp_path, "1.json", [{"id": "a"}])
    (tmp_path / "2.json").write_text('[{"id": "b"')
    with pytest.raises(Py4JJavaError, match="Malformed records"):
        read_pages(spark, str(tmp_path)).collect()


def test_normalize_leaves_absent_and_unknown_columns(spark):
    df = spark.createDataFrame([(None, "bad", 4)], "id string, latitude string, other int")
    out = bronze(df)
    assert out.dtypes == [("id", "string"), ("latitude", "double"), ("other", "int")]
    assert out.collect() == [("", None, 4)]


def test_golden_csv(spark, tmp_path):
    write_page(tmp_path / "pages", "1.json", RECORDS)
    paths = LakePaths(str(tmp_path / "lake"))
    run_bronze(spark, str(tmp_path / "pages"), paths, RUN)
    (file,) = csv_files(paths.raw_month(RUN))
    with open(file, encoding="utf-8", newline="") as landed:
        assert landed.read() == BRONZE_CSV
    assert paths.raw_month(RUN).endswith("raw/breweries/2026-01")


def test_known_columns_first_and_extras_by_name(spark, tmp_path):
    df = spark.createDataFrame(
        [("z", "1", "a", [1, 2])], "zz string, id string, aa string, list array<int>"
    )
    land_month(bronze(df), str(tmp_path / "m"), layout.BRONZE_COLUMNS)
    month = read_month(spark, str(tmp_path / "m"))
    assert month.columns == FIELDS + ["aa", "list", "zz"]
    assert month.select("id", "name", "aa", "list", "zz").first() == ("1", None, "a", "[1,2]", "z")


def test_files_with_other_fields_meet_by_name(spark, tmp_path):
    month = str(tmp_path / "m")
    for ddl in ("id string, b string", "a string, id string, b string", "id string"):
        names = [part.split()[0] for part in ddl.split(", ")]
        land_month(spark.createDataFrame([tuple(names)] * 2, ddl), month, ["id"])
    rows = read_month(spark, month)
    assert sorted(rows.columns) == ["a", "b", "id"]
    got = sorted(((r.id, r.a, r.b) for r in rows.collect()), key=str)
    assert got == sorted(
        [("id", None, "b")] * 2 + [("id", "a", "b")] * 2 + [("id", None, None)] * 2, key=str
    )


def test_runs_append_and_never_overwrite(spark, tmp_path):
    month = str(tmp_path / "m")
    rows = spark.range(1, 2, 1, 1).selectExpr("cast(id as string) AS id")
    land_month(rows, month, ["id"])
    first = set(csv_files(month))
    land_month(rows, month, ["id"])
    assert first < set(csv_files(month))
    assert read_month(spark, month).collect() == [("1",), ("1",)]


def test_files_are_bounded(spark, tmp_path):
    rows = spark.range(0, 100, 1, 1).selectExpr("cast(id as string) AS id")
    land_month(rows, str(tmp_path / "m"), ["id"], max_records_per_file=30)
    assert len(csv_files(tmp_path / "m")) == 4
    assert read_month(spark, str(tmp_path / "m")).distinct().count() == 100


def test_long_records_are_cut_by_bytes(spark, tmp_path):
    rows = spark.range(0, 40, 1, 1).selectExpr("cast(id as string) AS id", "repeat('x', 1000) AS t")
    land_month(rows, str(tmp_path / "m"), ["id"], max_bytes_per_file=10_100)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/m/*/*.csv")]
    assert len(sizes) >= 4 and max(sizes) < 12_000
    assert read_month(spark, str(tmp_path / "m")).count() == 40


def test_every_file_of_the_month_counts(spark, tmp_path):
    month = tmp_path / "m"
    extra = spark.createDataFrame([("1", "e")], "id string, extra string")
    land_month(extra, str(month), ["id"])
    plain = spark.createDataFrame([("2",)], "id string")
    land_month(plain, str(month), ["id"], compression="deflate")
    land_month(plain, str(month), ["id"], compression="gzip")
    land_month(plain, str(month), ["id"])
    (month / "by_hand.txt").write_text("id\n3\n")
    with gzip.open(month / "other.csv.gz", "wt") as file:
        file.write("id\n4\n")
    rows = read_month(spark, str(month))
    assert sorted(r.id for r in rows.collect()) == ["1", "2", "2", "2", "3", "4"]


@pytest.mark.parametrize("line", ["2,b,c", "2"])
def test_a_row_that_does_not_fit_its_header_fails_the_read(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"id,name\n1,a\n{line}\n")
    for columns in (["id", "name"], ["id"]):
        with pytest.raises(Py4JJavaError, match="MALFORMED"):
            read_month(spark, str(tmp_path)).select(*columns).collect()


def test_names_that_clash_by_case_are_not_landed(spark, tmp_path):
    rows = spark.createDataFrame([("1", "2")], "ID string, Name string")
    with pytest.raises(ValueError, match="differ only by case: id, name"):
        land_month(rows, str(tmp_path / "m"), ["id", "name"])
    assert not (tmp_path / "m").exists()


def test_another_column_order_in_the_month_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform to the schema"):
        read_month(spark, str(tmp_path)).collect()


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(
            st.one_of(
                st.sampled_from('",\\\n\r\t \u00a0#\'\0'),
                st.characters(exclude_categories=["Cs"]),
            ),
            max_size=12,
        ),
        min_size=1,
        max_size=20,
    )
)
def test_any_text_survives_the_month(spark, tmp_path_factory, texts):
    month = os.path.join(tmp_path_factory.mktemp("month"), "m")
    rows = [(str(i), text, "end") for i, text in enumerate(texts)]
    land_month(spark.createDataFrame(rows, "id string, v string, z string"), month, ["id"])
    got = sorted(read_month(spark, month).collect(), key=lambda r: int(r.id))
    assert got == [(i, text or None, end) for i, text, end in rows]


def test_landing_nothing_stops_the_run(spark, tmp_path):
    write_page(tmp_path / "pages", "1.json", [])
    paths = LakePaths(str(tmp_path / "lake"))
    with pytest.raises(EmptyLayer):
        run_bronze(spark, str(tmp_path / "pages"), paths, RUN)
    with pytest.raises(EmptyLayer):
        run_bronze(spark, str(tmp_path / "no pages"), paths, RUN)
    assert not os.path.exists(paths.root)
