from __future__ import annotations

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tarn.functions import (
    RunStamp,
    blank_missing,
    coerce_number,
    field,
    percent_of,
    render_stamp,
    tidy_number,
    tidy_text,
)


def cells(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_run_stamp_is_on_the_lake_clock():
    run = RunStamp.at(datetime(2026, 2, 1, 1, 30, tzinfo=UTC))
    assert run == RunStamp(20260131, 202601, 20260131223000)
    assert run.month == "2026-01"
    assert RunStamp.at(datetime(2026, 2, 1, 1, 30, tzinfo=UTC), "UTC").month == "2026-02"


def test_run_stamp_needs_a_zone():
    with pytest.raises(ValueError, match="time zone"):
        RunStamp.at(datetime(2026, 1, 1))


def test_run_stamp_now():
    before = RunStamp.at(datetime.now(UTC)).ts_proc
    assert before <= RunStamp.now().ts_proc <= RunStamp.at(datetime.now(UTC)).ts_proc


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_column_form_agrees_with_run_stamp(spark, zone):
    moments = [
        datetime(2026, 1, 1, 2, 59, 59, tzinfo=UTC),
        datetime(2018, 11, 4, 3, 0, 0, tzinfo=UTC),
        datetime(2018, 2, 18, 1, 30, 0, tzinfo=UTC),
        # Local times that clock changes skip or repeat in the other zones.
        datetime(2018, 3, 25, 5, 30, 0, tzinfo=UTC),
        datetime(2018, 10, 28, 5, 30, 0, tzinfo=UTC),
        datetime(2018, 3, 11, 5, 30, 0, tzinfo=UTC),
        datetime(2018, 11, 4, 4, 30, 0, 5000, tzinfo=UTC),
    ]
    name = "spark.sql.session.timeZone"
    before = spark.conf.get(name)
    spark.conf.set(name, zone)
    try:
        got = cells(spark, [m.replace(tzinfo=None) for m in moments], render_stamp, "timestamp_ntz")
    finally:
        spark.conf.set(name, before)
    assert [int(g) for g in got] == [RunStamp.at(m).ts_proc for m in moments]


def test_percent_of_more_than_the_whole(spark):
    got = spark.range(1).select(percent_of(F.lit(2000), F.lit(10))).first()[0]
    assert got == 20000.0


def test_blank_missing(spark):
    assert cells(spark, [None, "None", "none", " None", "", " "], blank_missing) == [
        "", "", "none", " None", "", " ",
    ]
    assert cells(spark, [None, 5], blank_missing, "int") == ["", "5"]


def test_coerce_number(spark):
    good = {" 1.5 ": 1.5, "-97.74": -97.74, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+3": 3.0}
    assert cells(spark, list(good), coerce_number) == list(good.values())
    bad = ["", "abc", "None", None, "nan", "NaN", "1.5d", "2f", "0x1p3", "1,5", "1e", "1e400"]
    assert cells(spark, bad, coerce_number) == [None] * len(bad)
    assert cells(spark, ["inf", "-Infinity"], coerce_number) == [float("inf"), float("-inf")]


def test_tidy_text_strips_spaces_only(spark):
    assert cells(spark, ["\ta  ", "\u00a0a\u00a0", "   ", None, " a b "], tidy_text) == [
        "\ta", "\u00a0a\u00a0", "", None, "a b",
    ]
    assert cells(spark, [7], tidy_text, "int") == ["7"]


def test_tidy_number_is_tolerant_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert cells(spark, [" 1.5 ", "abc", "", None], tidy_number) == [1.5, None, None, None]


def test_percent_of_rounds_as_python_does(spark):
    assert spark.range(1).select(percent_of(F.lit(0), F.lit(0))).first()[0] == 0.0
    totals = [1, 3, 7, 40, 800, 8000]
    df = spark.createDataFrame([(t,) for t in totals], "whole long").select(
        "whole", F.explode(F.sequence(F.lit(0).cast("long"), "whole")).alias("part")
    )
    rows = df.select("part", "whole", percent_of(F.col("part"), F.col("whole"))).collect()
    assert len(rows) == sum(totals) + len(totals)
    assert [r[2] for r in rows] == [round(r.part / r.whole * 100, 2) for r in rows]
    by_hand = {(1, 800): 0.12, (2675, 100000): 2.67, (1, 3): 33.33, (5, 5): 100.0}
    for (part, whole), expected in by_hand.items():
        got = spark.range(1).select(percent_of(F.lit(part), F.lit(whole))).first()[0]
        assert got == expected


@pytest.mark.parametrize("name", ["plain", "a.b", "two words", "tick`ed"])
def test_field_takes_any_name(spark, name):
    df = spark.range(1).toDF(name)
    assert df.select(field(name)).first()[0] == 0
