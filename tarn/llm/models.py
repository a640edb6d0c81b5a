"""Training a text classifier on a bounded labelled sample, and applying it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm.common import body, bound_batches, hold, picked, stored, values
from tarn.llm.ngrams import BITS, Featurizer, FollowTheRegularizedLeader, counted


def labelled_sample(
    docs: DataFrame, labels: DataFrame, bound: int, doc_id: str, text: str
) -> DataFrame:
    """``(id, label, text)`` of at most ``bound`` labelled documents, picked by hash.

    ``labels`` has ``id`` and ``label``. Rows where either is null are left out;
    of labels for the same id the largest counts, and of documents with the same
    id one. The ids that are broadcast are ``bound`` at most.
    """
    known = labels.where("id IS NOT NULL AND label IS NOT NULL")
    chosen = (
        known.groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(bound)
    )
    texts = picked(docs, id=doc_id, text=text).select(
        F.col("id").cast("bigint"), body("text").alias("text")
    )
    return texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"])


def fit(sample: DataFrame, classes: Sequence, epochs: int, featurizer: dict) -> np.ndarray:
    """One row of FTRL weights per class of ``sample.label``, that class against the rest.

    Features are made once, where the texts lie, and stored. An epoch is one task
    that streams through them, a batch at a time, from where the epoch before
    left the models; only the models' state comes to the driver.
    """
    bits = featurizer.get("bits", BITS)

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Featurizer(**featurizer)
        for batch in batches:
            pairs = [counted(maker.of(text)[0]) for text in values(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                    pa.array([p[1].astype(np.float32) for p in pairs], pa.list_(pa.float32())),
                ],
                ["id", "label", "buckets", "shares"],
            )

    kind = sample.schema["label"].dataType.simpleString()
    made = stored(
        sample.select("id", "label", "text").mapInArrow(
            featurize, f"id bigint, label {kind}, buckets array<int>, shares array<float>"
        )
    )

    ordered = made.coalesce(1).sortWithinPartitions(F.xxhash64("id", F.lit(1)), "id")
    context = sample.sparkSession.sparkContext
    models = [FollowTheRegularizedLeader(bits) for _ in classes]
    for _ in range(epochs):
        before = context.broadcast([model.state() for model in models])

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [FollowTheRegularizedLeader(bits, state=state) for state in before.value]
            for batch in batches:
                buckets, shares = batch.column("buckets"), batch.column("shares")
                for n, label in enumerate(batch.column("label").to_pylist()):
                    index, taken = buckets[n].values.to_numpy(), shares[n].values.to_numpy()
                    for model, value in zip(own, classes, strict=True):
                        model.learn(index, taken, float(label == value))
            for number, model in enumerate(own):
                index, z, squares = model.state()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(index), number, np.int32)),
                        pa.array(index.astype(np.int32)),
                        pa.array(z),
                        pa.array(squares),
                    ],
                    ["number", "bucket", "z", "n"],
                )

        learned = ordered.mapInArrow(learn, "number int, bucket int, z double, n double").toArrow()
        before.destroy()
        number, index, z, squares = (column.to_numpy() for column in learned.columns)
        models = [
            FollowTheRegularizedLeader(
                bits, state=(index[number == k], z[number == k], squares[number == k])
            )
            for k in range(len(classes))
        ]
    return np.array([model.weights() for model in models], np.float32)


def with_columns_of(
    docs: DataFrame,
    text: str,
    columns: T.StructType,
    make: Callable[[], Callable[[Iterator[str]], list[pa.Array]]],
) -> DataFrame:
    """``docs`` with ``columns`` computed from the text, a batch at a time.

    ``make`` runs once per task and returns the function of a batch's texts.
    Rows keep all their columns, whatever their names, and are not shuffled.
    New columns replace ones of the same name.
    """
    bound_batches(docs.sparkSession)
    kept = {i: n for i, n in enumerate(docs.columns) if n not in columns.fieldNames()}
    held = hold(docs).select(
        *[f"_c{i}" for i in kept], body(f"_c{docs.columns.index(text)}").alias("_text")
    )
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in held.schema.fields[:-1]] + columns.fields
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            made = compute(values(batch.column("_text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *made], [f.name for f in schema.fields]
            )

    out = held.mapInArrow(apply, schema)
    names = [F.col(f"_c{i}").alias(name) for i, name in kept.items()]
    return out.select(*names, *columns.fieldNames())
