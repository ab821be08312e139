"""Unions, counts and ranked tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; columns aligned by name, absent ones filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct()


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Frequency table, most frequent first, ties by value; ``top`` keeps the head (top-k, no full sort)."""
    counts = df.dropna(subset=[column]).groupBy(column).count().orderBy(F.desc("count"), F.asc(column))
    return counts.limit(top) if top else counts


def top_k(df: DataFrame, by: str, k: int, tie_break: str) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie_break)).limit(k)


def chronological(df: DataFrame, ts: str, series: tuple[str, ...] = ()) -> DataFrame:
    """Global order for a sink; operators never rely on it."""
    return df.orderBy(*series, F.col(ts).asc_nulls_last())
