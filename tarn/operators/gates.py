"""Gates: a run stops where a layer is missing or empty."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spark's names for a layer that is not there.
NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class EmptyLayer(ValueError):
    """A layer is missing or holds no rows."""

    def __init__(self, layer: str):
        super().__init__(f"no rows in {layer}")
        self.layer = layer


def require_rows(df: DataFrame, layer: str) -> DataFrame:
    """``df`` itself if it has a row. Looks for one row; counts nothing."""
    if df.isEmpty():
        raise EmptyLayer(layer)
    return df


def require_count(rows: int, layer: str) -> None:
    """The gate for rows that were counted while they were written."""
    if not rows:
        raise EmptyLayer(layer)


def require_layer(open_layer: Callable[[], DataFrame], layer: str) -> DataFrame:
    """The stored layer that ``open_layer`` reads, if it is there and has a row."""
    try:
        df = open_layer()
    except AnalysisException as error:
        if error.getCondition() in NOT_THERE:
            raise EmptyLayer(layer) from error
        raise
    return require_rows(df, layer)


def shape(df: DataFrame) -> DataFrame:
    """One row: the number of rows and of columns."""
    return df.agg(
        F.count("*").alias("qtd_linhas"),
        F.lit(len(df.columns)).cast("int").alias("qtd_colunas"),
    )
