"""Type coercion expressions: failures become null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 'D days HH:MM:SS.ffffff' (days part optional; a negative delta is written
# '-1 days +23:59:59.5'), the text form of a time delta.
TIMEDELTA_RE = r"^\s*(?:(-?\d+)\s+days?,?\s+)?\+?(\d{1,2}):(\d{2}):(\d{2}(?:\.\d+)?)\s*$"
FIRST_NUMBER_RE = r"([\d.]+)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def num_coerce(col) -> Column:
    """Text or number to DOUBLE; unparseable text to null."""
    return _c(col).try_cast("double")


def _group_num(s: Column, idx: int) -> Column:
    return F.nullif(F.regexp_extract(s, TIMEDELTA_RE, idx), F.lit("")).try_cast("double")


def duration_seconds(col) -> Column:
    """Duration text to seconds, decided per cell.

    Plain number -> that number; time-delta text -> total seconds; anything else -> the
    first run of digits/dots if it parses, else 0.  Null stays null.
    """
    s = _c(col).cast("string")
    td = (F.coalesce(_group_num(s, 1), F.lit(0.0)) * 86400.0
          + _group_num(s, 2) * 3600.0 + _group_num(s, 3) * 60.0 + _group_num(s, 4))
    digits = F.nullif(F.regexp_extract(s, FIRST_NUMBER_RE, 1), F.lit("")).try_cast("double")
    return (F.when(s.isNull(), F.lit(None).cast("double"))
            .otherwise(F.coalesce(s.try_cast("double"), td, digits, F.lit(0.0))))


def inf_to_zero(col) -> Column:
    """+inf, -inf, NaN and null to 0."""
    c = _c(col).cast("double")
    return (F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(0.0))
            .otherwise(c))


def bool_to_string(col) -> Column:
    """Boolean category to text ('true' / 'false'); null stays null."""
    return _c(col).cast("string")
