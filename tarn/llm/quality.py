"""A quality classifier: logistic regression on hashed word n-grams, by FTRL.

It learns from a bounded sample of the labelled documents and scores whole
texts as sparse dot products. Besides the words, n-grams of their shapes are
features (upper case, digits, punctuation, repetition), so that junk made of
words never seen before is still junk. Labels, languages, sources and ids are
never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm.common import hold, picked, release
from tarn.llm.models import fit, labelled_sample, with_columns_of
from tarn.llm.ngrams import Featurizer, margin, sigmoid

# Labelled documents that training uses at most, and passes over them.
MAX_LABELLED = 12_000
EPOCHS = 4
THRESHOLD = 0.7
FEATURES = {"orders": 2, "shape_orders": 3}


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from; false for a null id."""
    remainder = F.crc32(doc_id.cast("bigint").cast("string")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> np.ndarray:
    """Weights of the buckets, from labels of documents that are not held out.

    Without any label all weights are zero, and every score is a half.
    """
    known = (
        picked(labels, id=doc_id, label=label)
        .select(F.col("id").cast("bigint"), "label")
        .where(~held_out(F.col("id")))
    )
    sample = labelled_sample(docs, known, max_labelled, doc_id, text)
    return fit(sample, [1], EPOCHS, FEATURES)[0]


def score_quality(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability that a text's label is 1.

    Null texts count as empty ones, which get the score of no evidence. Rows
    are neither dropped nor shuffled; a column named ``score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        maker, own = Featurizer(**FEATURES), shared.value

        def scores(texts: Iterator[str]) -> list[pa.Array]:
            found = [sigmoid(margin(own, maker.of(text)[0])) for text in texts]
            return [pa.array(found, pa.float64())]

        return scores

    columns = T.StructType([T.StructField("score", T.DoubleType())])
    return with_columns_of(docs, text, columns, make)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``held_out``, ``score``, ``predicted``.

    Rows with null ids are scored like others. Empty tables give no rows, and
    further columns do not matter.
    """
    weights = train_quality(docs, labels, doc_id, text, label)
    rows = picked(docs, _id=doc_id, _t=text)
    return score_quality(rows, weights, "_t").select(
        F.col("_id").alias(doc_id),
        held_out(F.col("_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with all their columns."""
    weights = train_quality(docs, labels, doc_id, text, label)
    text_at = f"_c{docs.columns.index(text)}"
    scored = score_quality(hold(docs), weights, text_at).where(F.col("score") >= THRESHOLD)
    return release(scored, docs.columns)
