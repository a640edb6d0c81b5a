"""Column expressions and the run clock."""

from tarn.functions.cells import (
    blank_missing,
    coerce_number,
    field,
    percent_of,
    render_stamp,
    tidy_number,
    tidy_text,
)
from tarn.functions.clock import LAKE_ZONE, RunStamp

__all__ = [
    "LAKE_ZONE",
    "RunStamp",
    "blank_missing",
    "coerce_number",
    "field",
    "percent_of",
    "render_stamp",
    "tidy_number",
    "tidy_text",
]
