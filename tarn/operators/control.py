"""The volume control: how many rows a run produced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import field


def volume(df: DataFrame, table: str, stamps: Sequence[str]) -> DataFrame:
    """Rows of ``df`` per run stamp, labelled with the table's name."""
    labels = [F.lit(table).alias("name_file"), F.lit(table).alias("name_file_partition")]
    counts = df.groupBy(*[field(stamp) for stamp in stamps]).agg(
        F.count("*").alias("qtd_registros")
    )
    columns = [field(stamp) for stamp in stamps]
    return counts.select(*labels, *columns, "qtd_registros").orderBy(*columns)
