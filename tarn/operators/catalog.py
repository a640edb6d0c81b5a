"""The metadata catalogue: schema, dictionary and profile side by side."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.sources.tables import local_rows

STRUCTURE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ("coluna", "tipo", "tabela", "zona")]
)
DICTIONARY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ("coluna", "descricao")]
)


def structure(df: DataFrame, table: str, zone: str) -> DataFrame:
    """One row per column of ``df``: ``coluna``, ``tipo``, ``tabela``, ``zona``."""
    clashes = [name for name, n in Counter(c.lower() for c in df.columns).items() if n > 1]
    if clashes:
        raise ValueError(f"column names that differ only by case: {', '.join(sorted(clashes))}")
    rows = [(f.name, f.dataType.simpleString(), table, zone) for f in df.schema.fields]
    return local_rows(df.sparkSession, rows, STRUCTURE_SCHEMA)


def dictionary(spark: SparkSession, entries: Sequence[tuple[str, str]]) -> DataFrame:
    """The data dictionary: ``coluna``, ``descricao``."""
    return local_rows(spark, entries, DICTIONARY_SCHEMA)


def catalogue(columns: DataFrame, descriptions: DataFrame, figures: DataFrame) -> DataFrame:
    """Structure, with description and profile where a column has them.

    No side is hinted. The first two are local relations of known size, and the
    profile has one row per column, which AQE sees once it is computed.
    """
    name = F.lower(columns["coluna"])
    return (
        columns.join(descriptions, name == F.lower(descriptions["coluna"]), "left")
        .join(figures, name == F.lower(figures["coluna"]), "left")
        .select(
            columns["zona"],
            columns["tabela"],
            name.alias("coluna"),
            columns["tipo"],
            descriptions["descricao"],
            figures["qt_nulos"],
            figures["percent_nulos"],
            figures["cardinalidade"],
        )
    )
