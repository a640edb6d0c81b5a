from __future__ import annotations

import glob
import hashlib
import os

import pytest
from py4j.protocol import Py4JJavaError

from golden import (
    FIELDS,
    GOLD,
    GOLD_PROFILE,
    RECORDS,
    RUN,
    SILVER,
    SILVER_PROFILE,
    figures,
    write_page,
)
import tarn.sources.published as published_module
from tarn.__main__ import size_session
from tarn.functions import RunStamp
from tarn.operators import EmptyLayer
from tarn.plans import layers, layout, run_all, run_bronze, run_gold, run_silver, scale_settings
from tarn.plans.layers import completed
from tarn.sources import (
    IncompleteRun,
    LakePaths,
    read_month,
    read_rows,
    read_table,
    run_folders,
)

NEXT_DAY = RunStamp(20260116, 202601, 20260116060000)
NEXT_MONTH = RunStamp(20260201, 202602, 20260201060000)


@pytest.fixture
def lake(tmp_path):
    write_page(tmp_path / "pages", "1.json", RECORDS[:3])
    write_page(tmp_path / "pages", "2.json", RECORDS[3:])
    write_page(tmp_path / "pages", "3.json", [])
    return str(tmp_path / "pages"), LakePaths(str(tmp_path / "lake"))


def test_an_empty_result_leaves_the_old_table(spark, lake, monkeypatch):
    pages, paths = lake
    run_all(spark, pages, paths, RUN)
    def tables():
        return {zone: read_table(spark, getattr(paths, zone)).collect() for zone in ("silver", "gold")}

    before = tables()
    for function, layer, job in (("conform", "Silver", run_silver), ("count_by", "Gold", run_gold)):
        real = getattr(layers, function)
        monkeypatch.setattr(layers, function, lambda *args, real=real: real(*args).where("false"))
        with pytest.raises(EmptyLayer, match=f"{layer}, before the write"):
            job(spark, paths, NEXT_DAY)
    assert before == tables()


def test_the_command_line_sizes_the_session(spark, lake):
    pages, _ = lake
    session = spark.newSession()
    size_session(session, pages, 100 * 2**40)
    assert int(session.conf.get("spark.sql.shuffle.partitions")) == 50_000
    size_session(session, pages, None)
    cores = spark.sparkContext.defaultParallelism
    assert int(session.conf.get("spark.sql.shuffle.partitions")) == cores
    size_session(session, pages + "/none", None)


def test_stored_descriptions_are_pinned():
    digests = {
        "SILVER_DICTIONARY": "bcf8b51562293fbcc4f2280680382dec5b66adb96490a99cd99806c68db25b84",
        "GOLD_DICTIONARY": "5cbdb394f91e5cac633e63e83fe4d21279c7c84998bd3e14c059addaf715e9b7",
    }
    for name, digest in digests.items():
        text = "\n".join("\t".join(entry) for entry in getattr(layout, name))
        assert hashlib.sha256(text.encode()).hexdigest() == digest


def described(spark, paths, zone):
    return {r.coluna: r for r in read_table(spark, paths.metadata(zone)).collect()}


def test_the_chain_on_the_golden_records(spark, lake):
    pages, paths = lake
    gold = run_all(spark, pages, paths, RUN)
    assert sorted(map(tuple, gold.table.collect()), key=str) == sorted(GOLD, key=str)
    assert [tuple(r) for r in gold.preview.collect()] == GOLD

    silver = read_table(spark, paths.silver, layout.SILVER_SCHEMA)
    stamps = (RUN.ref, RUN.ref_partition, RUN.ts_proc, RUN.ts_proc)
    assert sorted(map(tuple, silver.collect())) == [stamps + row for row in SILVER]

    for zone, expected, table, words in (
        ("silver", SILVER_PROFILE, layout.SILVER_TABLE, layout.SILVER_DICTIONARY),
        ("gold", GOLD_PROFILE, layout.GOLD_TABLE, layout.GOLD_DICTIONARY),
    ):
        stored = read_table(spark, paths.metadata(zone))
        assert stored.columns == [
            "zona", "tabela", "coluna", "tipo", "descricao", "qt_nulos", "percent_nulos",
            "cardinalidade",
        ]
        assert figures(stored) == expected
        rows = described(spark, paths, zone)
        assert {(r.zona, r.tabela) for r in rows.values()} == {(zone, table)}
        assert {c: r.descricao for c, r in rows.items()} == dict(words)
        assert len(glob.glob(f"{paths.metadata(zone)}/_runs/*/*.parquet")) == 1

    assert read_rows(spark, paths.control("silver")).collect() == [
        ("silver_breweries", "silver_breweries", 202601, RUN.ts_proc, RUN.ts_proc, 4)
    ]
    assert read_rows(spark, paths.control("gold")).collect() == [
        ("gold_breweries", "gold_breweries", 202601, RUN.ts_proc, 3)
    ]
    assert len(glob.glob(f"{paths.gold}/_runs/*/*.parquet")) == 1


def test_silver_profile_sees_blank_keys_that_folders_cannot_hold(spark, tmp_path):
    records = [
        {"id": "1", "country": "   ", "state": "  "},
        {"id": "2", "country": None, "state": " "},
        {"id": "3", "country": "A", "state": "B"},
    ]
    write_page(tmp_path / "pages", "1.json", records)
    paths = LakePaths(str(tmp_path / "lake"))
    run_bronze(spark, str(tmp_path / "pages"), paths, RUN)
    for approx in (False, True):
        run_silver(spark, paths, RUN, approx=approx)
        rows = figures(read_table(spark, paths.metadata("silver")))
        assert rows["country"] == (1, 33.33, 3)
        assert rows["state"] == (0, 0.0, 2)
    silver = read_table(spark, paths.silver, layout.SILVER_SCHEMA)
    assert sorted((r.id, r.country, r.state) for r in silver.collect()) == [
        ("1", None, None), ("2", None, None), ("3", "A", "B"),
    ]


def test_a_second_run_overwrites_tables_and_appends_logs(spark, lake):
    pages, paths = lake
    run_all(spark, pages, paths, RUN)
    gold = run_all(spark, pages, paths, NEXT_DAY)
    # Bronze keeps both landings of the month, and Silver reads the month whole.
    assert {r.brewery_count for r in gold.table.collect()} == {2, 4}
    assert {r.ts_proc for r in gold.table.collect()} == {NEXT_DAY.ts_proc}
    silver = read_rows(spark, paths.control("silver")).orderBy("ts_proc").collect()
    assert [(r.ts_proc, r.qtd_registros) for r in silver] == [
        (RUN.ts_proc, 4), (NEXT_DAY.ts_proc, 8),
    ]
    assert read_rows(spark, paths.control("gold")).count() == 2
    assert read_table(spark, paths.metadata("silver")).count() == 20


def test_a_new_month_starts_afresh(spark, lake):
    pages, paths = lake
    run_bronze(spark, pages, paths, RUN)
    gold = run_all(spark, pages, paths, NEXT_MONTH)
    assert sum(r.brewery_count for r in gold.table.collect()) == 4


def test_jobs_stop_where_a_layer_is_missing(spark, lake):
    pages, paths = lake
    with pytest.raises(EmptyLayer, match="Bronze, month 2026-01"):
        run_silver(spark, paths, RUN)
    with pytest.raises(EmptyLayer, match="Silver"):
        run_gold(spark, paths, RUN)
    with pytest.raises(EmptyLayer, match="source pages"):
        run_all(spark, pages + "/none", paths, RUN)
    run_bronze(spark, pages, paths, RUN)
    with pytest.raises(EmptyLayer, match="month 2026-02"):
        run_silver(spark, paths, NEXT_MONTH)


def test_unknown_fields_stay_in_bronze_and_out_of_silver(spark, tmp_path):
    write_page(tmp_path / "pages", "1.json", [{"id": "1", "new": "n"}])
    paths = LakePaths(str(tmp_path / "lake"))
    run_bronze(spark, str(tmp_path / "pages"), paths, RUN)
    silver = run_silver(spark, paths, RUN).table
    assert silver.columns == layout.SILVER_SCHEMA.fieldNames()
    assert silver.first().id == "1"


def test_gold_as_one_file(spark, lake):
    pages, paths = lake
    run_bronze(spark, pages, paths, RUN)
    run_silver(spark, paths, RUN)
    run_gold(spark, paths, RUN, files=1)
    assert len(glob.glob(f"{paths.gold}/_runs/*/*.parquet")) == 1


def test_gold_reads_four_columns_of_silver(spark, lake):
    from tarn.operators import count_by

    pages, paths = lake
    run_bronze(spark, pages, paths, RUN)
    silver = run_silver(spark, paths, RUN).table
    plan = count_by(silver, layout.GOLD_KEYS, "n")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<brewery_type:string,city:string,state_province:string>" in plan


def test_scale_settings_grow_with_the_input_up_to_a_task_limit():
    def sizes(input_bytes, cores):
        settings = scale_settings(input_bytes, cores)
        return (
            int(settings["spark.sql.shuffle.partitions"]),
            int(settings["spark.sql.files.maxPartitionBytes"]),
        )

    assert sizes(10**9, cores=8) == (8, 256 * 2**20)
    assert sizes(10**12, cores=8) == (3726, 256 * 2**20)
    assert sizes(100 * 10**12, cores=4000) == (50_000, 2 * 10**9)


def test_command_line(spark, lake, capsys):
    from tarn.__main__ import main

    pages, paths = lake
    at = ["--at", "2026-01-15T06:00:00-03:00", "--root", paths.root]
    main(["all", "--pages", pages, *at])
    printed = capsys.readouterr().out
    assert "Porto Alegre" in printed and "20260115060000" in printed
    for moment, rows in ((at, 4), (["--at", "2026-01-16T06:00:00-03:00", *at[2:]], 8)):
        main(["bronze", "--pages", pages, "--fields", *FIELDS, *moment])
        main(["silver", *moment])
        main(["gold", "--approx", *moment])
        gold = read_table(spark, paths.gold, layout.GOLD_SCHEMA)
        # A landing that is repeated counts once, that of another run is added.
        assert sum(r.brewery_count for r in gold.collect()) == rows
    with pytest.raises(SystemExit):
        main(["bronze", *at])


def test_runs_of_a_month_may_differ_in_unknown_fields(spark, tmp_path):
    """Silver asks only for the known columns, which every file has in one place."""
    paths = LakePaths(str(tmp_path / "lake"))
    for name, extras in (("1", {"zeta": "z"}), ("2", {}), ("3", {"alpha": "a", "zeta": "z"})):
        write_page(tmp_path / name, "1.json", [{"id": name, "street": f"s{name}", **extras}])
        landed = RunStamp(RUN.ref, RUN.ref_partition, RUN.ts_proc + int(name))
        run_bronze(spark, str(tmp_path / name), paths, landed)
    silver = run_silver(spark, paths, RUN).table
    assert sorted((r.id, r.street) for r in silver.collect()) == [
        ("1", "s1"), ("2", "s2"), ("3", "s3"),
    ]


def test_silver_refuses_known_columns_in_another_place(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    write_page(tmp_path / "pages", "1.json", RECORDS)
    run_bronze(spark, str(tmp_path / "pages"), paths, RUN)
    for step in (1, -1):
        names = layout.BRONZE_COLUMNS[::step]
        with open(f"{paths.raw_month(RUN)}/foreign{step}.csv", "w", encoding="utf-8") as file:
            file.write(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform to the schema"):
        run_silver(spark, paths, RUN)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def break_once(monkeypatch, module, name):
    """The first call of ``module.name`` fails."""
    real, calls = getattr(module, name), []

    def failing(*args, **named):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("planned failure")
        return real(*args, **named)

    monkeypatch.setattr(module, name, failing)
    return calls


def test_a_landing_that_is_retried_counts_once(spark, lake):
    pages, paths = lake
    run_bronze(spark, pages, paths, RUN)
    run_bronze(spark, pages, paths, NEXT_DAY)
    run_bronze(spark, pages, paths, RUN)
    assert read_month(spark, paths.raw_month(RUN)).count() == 8
    folders = os.listdir(f"{paths.raw_month(RUN)}/_runs")
    assert sorted(f.split("-")[1] for f in folders) == [str(RUN.ts_proc), str(NEXT_DAY.ts_proc)]


def test_a_chain_goes_on_where_it_failed(spark, lake, monkeypatch):
    pages, paths = lake
    tried = break_once(monkeypatch, layers, "run_gold")
    landed = break_once(monkeypatch, layers, "run_bronze")
    landed.append("no failure wanted here")
    with pytest.raises(RuntimeError, match="planned"):
        run_all(spark, pages, paths, RUN)
    assert completed(spark, paths, RUN) == ["bronze", "silver"]
    gold = run_all(spark, pages, paths, RUN)
    assert completed(spark, paths, RUN) == ["bronze", "silver", "gold"]
    assert rows_of(gold.table) == sorted(GOLD, key=str)
    assert [tuple(r) for r in gold.preview.collect()] == GOLD
    # Bronze landed once, and a whole run that is started again does nothing.
    assert len(landed) == 2 and len(tried) == 2
    run_all(spark, pages, paths, RUN)
    assert len(landed) == 2 and len(tried) == 2
    assert rows_of(read_rows(spark, paths.control("gold"))) == [
        ("gold_breweries", "gold_breweries", 202601, RUN.ts_proc, 3)
    ]


def test_a_chain_builds_anew_what_another_run_replaced(spark, lake):
    pages, paths = lake
    run_all(spark, pages, paths, RUN)
    run_all(spark, pages, paths, NEXT_DAY)
    assert completed(spark, paths, RUN) == ["bronze"]
    gold = run_all(spark, pages, paths, RUN).table
    assert {r.ts_proc for r in gold.collect()} == {RUN.ts_proc}


@pytest.mark.parametrize("step", ["profile", "append_rows"])
def test_a_layer_without_its_last_record_is_not_whole(spark, lake, monkeypatch, step):
    pages, paths = lake
    run_bronze(spark, pages, paths, RUN)
    break_once(monkeypatch, layers, step)
    with pytest.raises(RuntimeError, match="planned"):
        run_silver(spark, paths, RUN)
    assert completed(spark, paths, RUN) == ["bronze"]
    run_silver(spark, paths, RUN)
    assert completed(spark, paths, RUN) == ["bronze", "silver"]
    assert read_rows(spark, paths.control("silver")).count() == 1


def test_the_next_layer_refuses_a_layer_that_lost_files(spark, lake):
    pages, paths = lake
    run_bronze(spark, pages, paths, RUN)
    run_silver(spark, paths, RUN)
    (folder,) = run_folders(spark, paths.silver, lambda records: records[-1:])
    os.remove(glob.glob(f"{folder}/country=Brazil/*/*.parquet")[0])
    with pytest.raises(IncompleteRun, match="published were"):
        run_gold(spark, paths, RUN)
    os.remove(glob.glob(f"{paths.raw_month(RUN)}/_runs/*/*.csv")[0])
    with pytest.raises(IncompleteRun):
        run_silver(spark, paths, RUN)


def test_a_half_written_layer_does_not_open_the_gate(spark, lake, monkeypatch):
    pages, paths = lake
    monkeypatch.setattr(published_module, "astuple", lambda record: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_bronze(spark, pages, paths, RUN)
    assert glob.glob(f"{paths.raw_month(RUN)}/_runs/*/*.csv")
    with pytest.raises(EmptyLayer, match="Bronze, month 2026-01"):
        run_silver(spark, paths, RUN)
    monkeypatch.undo()
    run_bronze(spark, pages, paths, RUN)
    assert run_silver(spark, paths, RUN).table.count() == 4
    # The retry took away what the failed landing left.
    assert len(os.listdir(f"{paths.raw_month(RUN)}/_runs")) == 1
