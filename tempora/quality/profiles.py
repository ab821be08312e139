"""Counters and timestamp profiles shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tempora.functions.timeline import DAY, HOUR, MINUTE, SECOND
from tempora.operators.chunks import CHUNK_ROWS, SLOT
from tempora.operators.columns import is_missing, numeric_columns
from tempora.operators.timeseries import distinct_timestamps, with_step
from tempora.operators.windows import order_check

TOP_INTERVALS = 10


def is_infinite(c: Column) -> Column:
    return F.abs(c.cast("double")) == F.lit(float("inf"))


def is_non_finite(df: DataFrame, name: str) -> Column:
    return is_missing(df, name) | F.coalesce(is_infinite(F.col(name)), F.lit(False))


def counter_map(counters: dict[str, Column], keep_zero: bool = False) -> Column:
    """Aggregate expression: map column name -> count, by default only the non-zero ones."""
    if not counters:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    entries = F.array(
        *[F.struct(F.lit(k).alias("key"), F.count_if(v).alias("value")) for k, v in counters.items()]
    )
    return F.map_from_entries(entries if keep_zero else F.filter(entries, lambda e: e["value"] > 0))


def missing_counters(df: DataFrame, columns: list[str] | None = None) -> dict[str, Column]:
    return {c: is_missing(df, c) for c in (df.columns if columns is None else columns)}


def infinite_counters(df: DataFrame, columns: list[str] | None = None) -> dict[str, Column]:
    return {c: is_infinite(F.col(c)) for c in numeric_columns(df, columns)}


def _long(df: DataFrame, counters: dict[str, Column], name: str) -> DataFrame:
    counted = df.agg(counter_map(counters).alias("m"))
    return counted.select(F.explode("m").alias("column_name", name))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count) for columns with missing values: one aggregate, then an explode."""
    return _long(df, missing_counters(df, columns), "null_count")


def infinite_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _long(df, infinite_counters(df, columns), "infinite_count")


def interval_text(name: str) -> Column:
    """``0 days 00:30:00`` notation of a column of non-negative microseconds."""
    us = f"cast({name} as bigint)"
    rest = f"({us} % {DAY}L)"
    whole = (
        f"format_string('%d days %02d:%02d:%02d', {us} div {DAY}L, {rest} div {HOUR}L,"
        f" ({rest} % {HOUR}L) div {MINUTE}L, ({rest} % {MINUTE}L) div {SECOND}L)"
    )
    return F.expr(f"if({us} % {SECOND}L = 0, {whole}, concat({whole}, format_string('.%06d', {us} % {SECOND}L)))")


def interval_counts(
    df: DataFrame,
    ts: str,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """(step_micros, n): how often each distance between consecutive timestamps occurs.

    Copies of a timestamp are counted map-side first and contribute zero distances, so a timestamp
    shared by a large part of the rows never has to be ordered.
    """
    unique = distinct_timestamps(df, ts, series).dropna(subset=[ts])
    steps = with_step(unique, ts, series, chunk_rows=chunk_rows, slot=slot, plan_from=df)
    pairs = F.array(
        F.struct(F.col("step_micros").alias("step_micros"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit(0).cast("bigint").alias("step_micros"), (F.col("copies") - 1).alias("n")),
    )
    long = steps.select(F.explode(pairs).alias("p")).select("p.*").filter("step_micros is not null and n > 0")
    return long.groupBy("step_micros").agg(F.sum("n").alias("n"))


def timestamp_profile(
    df: DataFrame,
    ts: str,
    series: tuple[str, ...] = (),
    ordinal: str | Sequence[str] | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """One row: invalid and duplicate counts, order, range and the most common intervals.

    Frames have no inherent order; without an ``ordinal`` the sorted order is meant, which only a
    missing timestamp can break.
    """
    missing = F.col(ts).isNull()
    null_keys = F.count_distinct(F.when(missing, F.struct(*series))) if series else F.max(missing.cast("int"))
    base = df.agg(
        F.count_if(missing).alias("invalid_timestamp_count"),
        F.coalesce(null_keys, F.lit(0)).alias("__null_keys"),
        F.min(ts).alias("minimum_timestamp"),
        F.max(ts).alias("maximum_timestamp"),
    )
    # The zero distances (repeats) and the most common others, at most TOP_INTERVALS + 1 rows.
    head = (
        interval_counts(df, ts, series, chunk_rows, slot)
        .orderBy(F.desc(F.col("step_micros") == 0), F.desc("n"), F.asc("step_micros"))
        .limit(TOP_INTERVALS + 1)
        .withColumn("step", interval_text("step_micros"))
        .agg(
            F.struct(
                F.expr("coalesce(sum(if(step_micros = 0, n, 0)), 0)").alias("repeats"),
                F.expr(f"slice(sort_array(collect_list(struct(-n as m, step_micros, step))), 1, {TOP_INTERVALS})").alias("top"),
            ).alias("h")
        )
    )
    found = base.withColumn("__h", head.scalar())
    if ordinal:
        monotonic = order_check(df, ts, ordinal, series).scalar()
    else:
        monotonic = F.col("invalid_timestamp_count") == 0
    return found.select(
        "invalid_timestamp_count",
        F.expr("invalid_timestamp_count - __null_keys + __h.repeats").alias("duplicate_timestamp_count"),
        F.coalesce(monotonic, F.lit(True)).alias("is_monotonic_increasing"),
        "minimum_timestamp",
        "maximum_timestamp",
        F.expr("map_from_entries(transform(__h.top, e -> struct(e.step, -e.m)))").alias("most_common_intervals"),
    )


def as_struct(df: DataFrame) -> Column:
    """A one-row frame as a scalar struct."""
    return df.select(F.struct(*df.columns)).scalar()
