"""Lenient and strict conversions of text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tempora.schemas import TIMESTAMP_PATTERN

# Fixed pattern: decimal notation with optional sign, fraction and exponent.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def lenient_timestamp(c: Column | str, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Parse with a pattern; anything that does not fit becomes null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(pattern)).cast("timestamp_ntz")


def strict_timestamp(c: Column | str) -> Column:
    """Parse an ISO timestamp; raises under ANSI when it does not fit."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")


def lenient_double(c: Column | str) -> Column:
    """Parse a number; text that is not a plain decimal number becomes null (no ``1d`` suffixes)."""
    col = F.col(c) if isinstance(c, str) else c
    text = col.cast("string")
    is_number = text.rlike(NUMBER_PATTERN) | text.rlike(INFINITY_PATTERN)
    return F.when(is_number, F.trim(text).try_cast("double"))


def strict_double(c: Column | str) -> Column:
    """Parse a number; raises under ANSI when it does not fit. NaN becomes null."""
    col = F.col(c) if isinstance(c, str) else c
    return nan_to_null(col.cast("double"))


def nan_to_null(c: Column | str) -> Column:
    """One notion of missing: NaN is mapped to null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col), col)


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("tinyint")
