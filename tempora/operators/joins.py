"""One-to-one joins and key coverage."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

from tempora.errors import GuardError
from tempora.operators.columns import is_missing, require_columns, require_rows
from tempora.operators.dedup import duplicate_count
from tempora.schemas import TS, WEATHER_COLUMNS


def require_unique(df: DataFrame, keys: list[str], stage: str) -> None:
    """One aggregate; raises when a key value repeats or is missing."""
    n = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("dup"),
            F.count_if(reduce(or_, [F.col(k).isNull() for k in keys])).alias("missing"),
        )
        .first()
    )
    if n["missing"]:
        raise GuardError(f"{stage}: missing key values in {keys}")
    if n["dup"]:
        raise GuardError(f"{stage}: {n['dup']} repeated key values in {keys}")


def join_one_to_one(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", check: bool = True
) -> DataFrame:
    """Equi-join whose keys are unique on both sides.

    The strategy is left to Spark: a small side is broadcast by its measured size, otherwise both
    sides shuffle on the key, which is unique and therefore cannot be skewed.
    """
    require_columns(left, keys, "join, left side")
    require_columns(right, keys, "join, right side")
    if check:
        require_unique(left, keys, "join, left side")
        require_unique(right, keys, "join, right side")
    return left.join(right, keys, how)


def join_many_to_one(left: DataFrame, right: DataFrame, keys: list[str], left_keys: list[str], how: str = "left", check: bool = True) -> DataFrame:
    """Equi-join on ``keys``, unique on the right; the left rows are unique on ``left_keys``, which hold the keys and more.

    Many left rows may share a key (several series, one companion); no row is multiplied.
    """
    require_columns(left, [*keys, *left_keys], "join, left side")
    require_columns(right, keys, "join, right side")
    if check:
        require_unique(left, left_keys, "join, left side")
        require_unique(right, keys, "join, right side")
    return left.join(right, keys, how).select(*left.columns, *[c for c in right.columns if c not in keys])


def attach_weather(
    demand: DataFrame,
    weather: DataFrame,
    keys: list[str] | None = None,
    columns: list[str] | None = None,
    on_unmatched: str = "report",
    check: bool = True,
    demand_keys: list[str] | None = None,
) -> DataFrame:
    """Left join of the weather columns onto the demand rows.

    ``demand_keys`` names what makes a demand row unique, by default the join keys; with (series, timestamp) there, several
    series share one weather series.
    ``on_unmatched="error"`` raises when a demand row has no weather or only part of it;
    ``"report"`` leaves the gaps for the merge report.
    """
    keys = keys or [TS]
    columns = WEATHER_COLUMNS if columns is None else columns
    if on_unmatched not in ("error", "report"):
        raise ValueError("on_unmatched must be 'error' or 'report'")
    require_columns(weather, [*keys, *columns], "weather")
    narrow = weather.select(*keys, *columns)
    if check:
        require_rows(demand, "demand")
        require_rows(weather, "weather")
    merged = join_many_to_one(demand, narrow, keys, demand_keys or keys, "left", check)
    if on_unmatched == "error":
        gaps = [is_missing(merged, c) for c in columns]
        row = merged.agg(
            F.count_if(reduce(and_, gaps)).alias("unmatched"), F.count_if(reduce(or_, gaps)).alias("incomplete")
        ).first()
        if row["incomplete"]:
            raise GuardError(
                f"{row['unmatched']} rows have no weather and {row['incomplete']} rows lack part of it"
            )
    return merged


def unmatched_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-null keys of ``left`` that ``right`` does not have."""
    return left.select(*keys).dropna().distinct().join(right.select(*keys), keys, "left_anti")


def key_coverage(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys per side, matched, unmatched, extra and the match rate, in one aggregate.

    A tagged union grouped by key needs a single shuffle and combines map-side.
    """
    tagged = left.select(*keys, F.lit(1).alias("__side")).unionByName(right.select(*keys, F.lit(2).alias("__side")))
    sides = tagged.dropna(subset=keys).groupBy(*keys).agg(F.bit_or("__side").alias("__s"))
    s = F.col("__s")
    counts = sides.agg(
        F.count_if(s != 2).alias("left_keys"),
        F.count_if(s != 1).alias("right_keys"),
        F.count_if(s == 3).alias("matched"),
        F.count_if(s == 1).alias("unmatched"),
        F.count_if(s == 2).alias("extra"),
    )
    rate = F.when(F.col("left_keys") > 0, F.col("matched") / F.col("left_keys")).otherwise(F.lit(0.0))
    return counts.withColumn("match_rate", rate)


def split_overlap(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Keys shared by each pair of parts, from one grouped union."""
    names = list(parts)
    tagged = [p.select(*keys, F.lit(1 << i).alias("__part")) for i, p in enumerate(parts.values())]
    union = reduce(DataFrame.unionByName, tagged).dropna(subset=keys)
    bits = union.groupBy(*keys).agg(F.bit_or("__part").alias("__bits"))
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    return bits.agg(
        *[
            F.count_if(F.col("__bits").bitwiseAND((1 << i) | (1 << j)) == ((1 << i) | (1 << j))).alias(
                f"{names[i]}_{names[j]}"
            )
            for i, j in pairs
        ]
    )


__all__ = [
    "attach_weather",
    "duplicate_count",
    "join_many_to_one",
    "join_one_to_one",
    "key_coverage",
    "require_unique",
    "split_overlap",
    "unmatched_keys",
]
