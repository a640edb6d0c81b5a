"""The column quality profile: type, nulls, percent null, cardinality."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import field, percent_of
from tarn.sources.tables import local_rows

# Columns per pass. A task holds the distinct values of one pass's columns at a
# time, so this bounds its memory; Spark compiles ``stack`` up to 50 rows.
PASS_COLUMNS = 8
# Columns per pass of the estimate, which holds one sketch per column.
SKETCH_COLUMNS = 32
# Text of this many bytes or more is grouped by its 64-character digest.
DIGEST_FROM = 64

WHOLE_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTION_TYPES = (T.FloatType, T.DoubleType)

Fields = list[tuple[int, T.StructField]]

FIGURES_SCHEMA = T.StructType(
    [T.StructField("i", T.IntegerType())]
    + [T.StructField(name, T.LongType()) for name in ("total", "nulls", "distinct")]
)

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("coluna", T.StringType()),
        T.StructField("tipo", T.StringType()),
        T.StructField("qt_nulos", T.LongType()),
        T.StructField("percent_nulos", T.DoubleType()),
        T.StructField("cardinalidade", T.LongType()),
    ]
)


def profile(
    df: DataFrame,
    approx: bool = False,
    blank_keys: Mapping[str, int] | None = None,
    isolate: bool = False,
) -> DataFrame:
    """One row per column of ``df``: ``coluna``, ``tipo``, ``qt_nulos``,
    ``percent_nulos``, ``cardinalidade``; most NULLs first.

    Cardinality counts NULL as one value. Columns whose values cannot be
    compared (maps, variants) keep their row, with NULL figures.

    The exact plan is for stored tables: it reads each column once, in narrow
    passes over a few columns of one type. ``approx`` estimates the cardinality;
    its passes shuffle one row per task.

    ``blank_keys`` is for a partitioned table profiled after it was written:
    how many of a key column's NULLs had been ``''`` (``write_partitioned``).

    With ``isolate`` the figures are computed at once, and a column whose values
    cannot be computed (a cast that fails, a broken column chunk) costs its own
    figures only: it keeps its row, with NULL figures and a warning.
    """
    fields = df.schema.fields
    if not fields:
        return local_rows(df.sparkSession, [], PROFILE_SCHEMA)
    plan = _approximate if approx else _exact
    members = list(enumerate(fields))
    figures = _apart(df, members, plan) if isolate else plan(df, members)
    figures = _with_blanks(figures, fields, blank_keys or {})
    comparable = F.col("i").isin([i for i, f in enumerate(fields) if _comparable(f.dataType)])
    if isolate:
        comparable &= F.col("total").isNotNull()
    return figures.select(
        _pick("i", [f.name for f in fields]).alias("coluna"),
        _pick("i", [f.dataType.simpleString() for f in fields]).alias("tipo"),
        F.when(comparable, F.col("nulls")).alias("qt_nulos"),
        F.when(comparable, percent_of(F.col("nulls"), F.col("total"))).alias("percent_nulos"),
        F.when(comparable, F.col("distinct")).alias("cardinalidade"),
        "i",
    ).orderBy(F.desc("percent_nulos"), "i").drop("i")


def _apart(
    df: DataFrame, fields: Fields, plan: Callable[[DataFrame, Fields], DataFrame]
) -> DataFrame:
    """The figures of ``plan``, of which columns that fail have none.

    All columns run together first. Where that fails the columns are halved
    until those that fail are alone: some log2(columns) more runs for each of
    them, and none where all is well. If every column fails, the last error is
    raised, for then it is not a column's.
    """
    failed: dict[int, Exception] = {}

    def attempt(members: Fields) -> list[tuple]:
        try:
            return [tuple(row) for row in plan(df, members).collect()]
        except (PySparkException, Py4JJavaError) as error:
            if len(members) == 1:
                failed[members[0][0]] = error
                return [(members[0][0], None, None, None)]
        middle = len(members) // 2
        return attempt(members[:middle]) + attempt(members[middle:])

    rows = attempt(fields)
    if len(failed) == len(fields):
        raise list(failed.values())[-1]
    for i, error in failed.items():
        reason = str(error).strip().splitlines()[0]
        warnings.warn(f"no figures for column {fields[i][1].name}: {reason}", stacklevel=3)
    return local_rows(df.sparkSession, rows, FIGURES_SCHEMA)


def _exact(df: DataFrame, fields: Fields) -> DataFrame:
    """``(i, total, nulls, distinct)`` from a count of every (column, value).

    Tasks count before the shuffle, so a hot value costs one row per task, and
    only (column number, value) is shuffled. One seed per column makes columns
    without rows appear.
    """
    numbers = F.array(*[F.lit(i) for i, _ in fields])
    seeds = df.sparkSession.range(0, len(fields), 1, 1).select(
        F.get(numbers, F.col("id").cast("int")).alias("i"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(False).alias("is_null"),
    )
    counted = [
        df.select(_stacked(group))
        .groupBy("i", "v")
        .agg(F.count("*").alias("n"))
        .select("i", "n", F.col("v").isNull().alias("is_null"))
        for group in _groups(fields)
    ]
    return (
        reduce(DataFrame.unionByName, counted, seeds)
        .groupBy("i")
        .agg(
            F.sum("n").alias("total"),
            F.sum(F.when(F.col("is_null"), F.col("n")).otherwise(0)).alias("nulls"),
            F.count_if(F.col("n") > 0).alias("distinct"),
        )
    )


def _groups(fields: Fields) -> Iterable[list[tuple[int, Column]]]:
    """Columns that share one pass: of one carrier type, and few."""
    families: dict[str, list[tuple[int, Column]]] = {}
    for i, f in fields:
        if _comparable(f.dataType):
            family, value = _carrier(f)
            families.setdefault(family, []).append((i, value))
    for members in families.values():
        for start in range(0, len(members), PASS_COLUMNS):
            yield members[start : start + PASS_COLUMNS]


def _stacked(group: list[tuple[int, Column]]) -> Column:
    cells = [cell for i, value in group for cell in (F.lit(i), value)]
    return F.stack(F.lit(len(group)), *cells).alias("i", "v")


def _carrier(f: T.StructField) -> tuple[str, Column]:
    """The family of a column and its values, one to one, in the family's type."""
    value = field(f.name)
    if _plain_text(f.dataType):
        return "text", _digest(value)
    if isinstance(f.dataType, T.BinaryType):
        return "text", _digest(F.hex(value))
    if isinstance(f.dataType, T.ArrayType) and _renders_one_to_one(f.dataType.elementType):
        if isinstance(f.dataType.elementType, FRACTION_TYPES):
            # Equal values must look equal: no negative zero.
            value = F.transform(value, lambda x: x + F.lit(0.0).cast(f.dataType.elementType))
        return "text", _digest(F.to_json(value))
    if isinstance(f.dataType, WHOLE_TYPES):
        return "whole", value.cast("bigint")
    if isinstance(f.dataType, FRACTION_TYPES):
        return "fraction", value.cast("double")
    return f.dataType.simpleString(), value


def _digest(value: Column) -> Column:
    """Text as it is while it is short, else its digest, so that long values
    don't travel."""
    return F.when(F.octet_length(value) >= DIGEST_FROM, F.sha2(value, 256)).otherwise(value)


def _plain_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType) and kind.isUTF8BinaryCollation()


def _renders_one_to_one(kind: T.DataType) -> bool:
    """Whether different elements have different JSON forms."""
    return isinstance(kind, (*WHOLE_TYPES, *FRACTION_TYPES)) or _plain_text(kind)


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _approximate(df: DataFrame, fields: Fields) -> DataFrame:
    """``(i, total, nulls, distinct)`` with an estimated ``distinct``.

    One aggregate per pass: a sketch is some 50 buffer fields per column, too
    many for one aggregate over a wide table.
    """
    passes = [
        _estimated(df, fields[start : start + SKETCH_COLUMNS])
        for start in range(0, len(fields), SKETCH_COLUMNS)
    ]
    return reduce(DataFrame.unionByName, passes)


def _estimated(df: DataFrame, fields: Fields) -> DataFrame:
    aggregates = [F.count("*").alias("total")]
    rows = []
    for i, f in fields:
        nulls = distinct = F.lit(None).cast("bigint")
        if _comparable(f.dataType):
            value = field(f.name)
            aggregates.append(F.count(value).alias(f"filled_{i}"))
            aggregates.append(F.approx_count_distinct(value).alias(f"distinct_{i}"))
            nulls = F.col("total") - F.col(f"filled_{i}")
            distinct = F.col(f"distinct_{i}") + F.when(nulls > 0, 1).otherwise(0)
        rows.append(
            F.struct(
                F.lit(i).alias("i"),
                F.col("total"),
                nulls.alias("nulls"),
                distinct.alias("distinct"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _with_blanks(
    figures: DataFrame, fields: list[T.StructField], blank_keys: Mapping[str, int]
) -> DataFrame:
    """Give back to key columns the blanks that the folder names made NULL."""
    if not any(blank_keys.values()):
        return figures
    blanks = _pick("i", [blank_keys.get(f.name, 0) for f in fields]).cast("bigint")
    nulls = F.col("nulls") - blanks
    both = (blanks > 0) & (nulls > 0)
    return figures.withColumns(
        {"nulls": nulls, "distinct": F.col("distinct") + F.when(both, 1).otherwise(0)}
    )


def _pick(index: str, values: list) -> Column:
    """``values[index]``, known to Catalyst as never NULL.

    Were it nullable, a join on the name would filter every (column, value) row
    before the shuffle by looking its name up.
    """
    return F.coalesce(F.get(F.array(*[F.lit(v) for v in values]), F.col(index)), F.lit(values[0]))
