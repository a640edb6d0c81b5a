"""Documents that every operator must take: nulls, empties, repeats, long texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "_full string, print bigint, TEXT string, page_bits string, score double, page bigint, "
    "bucket int, rate double, maybe_dropped boolean, component_id bigint"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def sentence(start: int, words: int) -> str:
    return " ".join(f"{WORDS[(start * 7 + i) % 10]}{(start + i * i) % 97}" for i in range(words))


TEXTS = [
    (1, sentence(1, 40)),
    (2, sentence(2, 40)),
    (3, sentence(1, 40)),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "one"),
    (8, "one two"),
    (9, "x" * 300_000),
    (10, sentence(3, 30_000)),
    (11, "a,b " * 5_000),
    (12, "naïve café   \U0001f600 é \x00 \x01\x02\x1c end"),
    (None, sentence(1, 40)),
    (None, None),
    (13, sentence(4, 12)),
    (13, sentence(4, 12)),
    (14, sentence(5, 12)),
    (14, sentence(6, 12)),
    (-3, "ONE two"),
]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) among columns whose names clash with ours."""
    full = [
        (doc_id, text, "en", None, None, "f", 7, "other", "b", 0.5, 1, 2, 1.5, True, 99)
        for doc_id, text in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def odd(spark: SparkSession) -> DataFrame:
    return frame(spark, TEXTS)


def empty(spark: SparkSession) -> DataFrame:
    return frame(spark, [])
