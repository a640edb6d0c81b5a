"""Cell-level expressions. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn.functions.clock import LAKE_ZONE

# The text that counts as missing in a raw record, and the number
# spellings a coordinate may have. Java would also read "1d" and "0x1p3".
MISSING_TEXT = "None"
FINITE_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Where the parts of a wall clock stand in its text form: position and length.
CLOCK_PARTS = {
    "yyyy": (1, 4),
    "MM": (6, 2),
    "dd": (9, 2),
    "HH": (12, 2),
    "mm": (15, 2),
    "ss": (18, 2),
}
INFINITE_NUMBER = r"^\s*[+-]?(?i:inf|infinity)\s*$"


def field(name: str) -> Column:
    """A top-level column by its exact name, dots, spaces and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_missing(cell: Column) -> Column:
    """Raw cell as text, with NULL and the text ``None`` turned into ``''``."""
    text = cell.cast("string")
    return F.when(text.isNull() | (text == MISSING_TEXT), F.lit("")).otherwise(text)


def coerce_number(cell: Column) -> Column:
    """Raw cell as a double; whatever is not a number (NaN too) becomes NULL."""
    text = cell.cast("string")
    number = text.try_cast("double")
    finite = text.rlike(FINITE_NUMBER) & (F.abs(number) < float("inf"))
    return F.when(finite | text.rlike(INFINITE_NUMBER), number)


def tidy_text(cell: Column) -> Column:
    """Text without leading or trailing spaces; tabs and no-break spaces stay."""
    return F.trim(cell).cast("string")


def tidy_number(cell: Column) -> Column:
    """Double by a tolerant cast: bad text gives NULL under ANSI mode too."""
    return cell.try_cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` with two decimals; 0.0 of nothing.

    Rounds the double's exact binary value, ties to even, as Python's ``round``
    does. ``bround`` rounds its shortest decimal form and differs on many ties.
    """
    percent = F.call_function("format_number", part / whole * 100, F.lit("0.00")).cast("double")
    return F.when(whole > 0, percent).otherwise(F.lit(0.0))


def render_stamp(
    moment: Column,
    pattern: str = "yyyyMMddHHmmss",
    zone: str = LAKE_ZONE,
    source_zone: str = "UTC",
) -> Column:
    """A wall-clock column of ``source_zone`` as text on the lake's clock.

    The column form of :class:`tarn.functions.clock.RunStamp`. ``pattern`` is
    made of ``yyyy MM dd HH mm ss`` and other text. The parts are taken from the
    wall clock itself: ``date_format`` would pass it through the session's zone,
    where that moment may not exist.
    """
    local = F.convert_timezone(
        F.lit(source_zone), F.lit(zone), moment.cast("timestamp_ntz")
    )
    clock = local.cast("string")
    parts = [part for part in re.split("(yyyy|MM|dd|HH|mm|ss)", pattern) if part]
    return F.concat(
        *[
            F.substring(clock, *CLOCK_PARTS[part]) if part in CLOCK_PARTS else F.lit(part)
            for part in parts
        ]
    )
