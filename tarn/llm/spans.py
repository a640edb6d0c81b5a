"""Spans of text as arrays of structs, and their string form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start first, then the kind's place in its list: the order of sorting.
SPAN_TYPE = "struct<start:bigint,rank:int,kind:string,end:bigint>"
SPANS_TYPE = f"array<{SPAN_TYPE}>"


def no_spans() -> Column:
    return F.array().cast(SPANS_TYPE)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank, joined by commas."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def span_columns(spans: str, base: Sequence[str]) -> list[Column]:
    """Counts of the ``base`` kinds and the digest of their spans."""
    own = F.filter(F.col(spans), lambda s: s["kind"].isin(list(base)))
    return [
        *[count_kind(F.col(spans), kind).alias(f"n_{kind}") for kind in base],
        F.sha2(spans_text(own), 256).alias("base_sha256"),
    ]
