"""The corpus pipeline: documents to packed sequences.

Low-quality documents go, then exact copies, then near copies; the rest is
mixed to language targets by repeating documents of scarce languages, and
packed. Every stage but the last returns the columns of ``documents``; between
stages the rows are written to the shared folder and read again.

Null texts are empty ones, and empty tables stay empty. A row with a null id is
scored and packed like any other; it is a copy of an equal text with an id, is
kept by the near-copy stage, and is used once in the mixture. Rows that repeat
both id and text count as one document from the second stage on. Further columns
of ``documents`` pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarn.llm.common import stored, table
from tarn.llm.exact_dedup import drop_exact_copies
from tarn.llm.mixing import mix
from tarn.llm.packing import pack_documents
from tarn.llm.quality import keep_good
from tarn.llm.queries import LANGUAGE_TARGETS, VOCABULARY, labelled_languages
from tarn.llm.simhash import drop_near_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on ``labels``, calls good."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest id."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of scarce languages more often."""
    labelled = labelled_languages(spark, sf_dir)
    return mix(docs, labelled, LANGUAGE_TARGETS, keep_all=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, placed in sequences of 2048 tokens."""
    return pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing to target weights", mixture),
    ("best-fit packing", packing),
]

# Training, linking and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
