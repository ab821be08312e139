"""Duplicate removal and late corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tempora.operators.columns import require_columns
from tempora.schemas import CHANGED, SERIES, TS


def drop_exact_duplicates(df: DataFrame, position: str | None = None) -> DataFrame:
    """Distinct rows; an ingest position does not count as content and keeps its first value."""
    if position is None:
        return df.dropDuplicates()
    content = [c for c in df.columns if c != position]
    return df.groupBy(*content).agg(F.min(position).alias(position)).select(*df.columns)


def latest_per_key(
    df: DataFrame,
    keys: tuple[str, ...] = (SERIES, TS),
    changed: str = CHANGED,
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """The most recently changed row per key; a missing change time counts as newest.

    ``max_by`` combines map-side, so a key with any number of copies reaches its reducer as one row
    per task, where a ranking window would sort all copies in one place. Columns in ``tie_break``
    are compared in order; pass the ingest position to reproduce "last one read wins".
    """
    require_columns(df, [*keys, changed, *tie_break], "latest per key")
    rank: Column = F.struct(
        F.col(changed).isNull().alias("r0"),
        F.col(changed).alias("r1"),
        *[F.col(c).alias(f"r{i + 2}") for i, c in enumerate(tie_break)],
    )
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def duplicate_count(df: DataFrame, keys: list[str], name: str = "duplicate_count") -> DataFrame:
    """Rows beyond the first of each key; null counts as a key value."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias(name))
    )


def upsert(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``base`` whose key is not updated, plus all of ``updates``."""
    fresh = updates.select(*keys).distinct()
    return base.join(fresh, keys, "left_anti").unionByName(updates)
