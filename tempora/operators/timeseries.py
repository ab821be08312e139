"""Gap detection, continuity, up-sampling and slot aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tempora.errors import GuardError
from tempora.functions.casts import flag
from tempora.functions.timeline import HOUR, MINUTE, floor_to, micros, micros_sql, shift
from tempora.operators.chunks import CHUNK_ROWS, SLOT, ordered_windows
from tempora.operators.columns import require_columns
from tempora.schemas import TS


#: Grid points of a gap that are expanded at once.
GAP_PIECE = 100_000


def resample_sum(
    df: DataFrame, ts: str, value: Column, step: int, name: str, out_ts: str = TS, series: tuple[str, ...] = ()
) -> DataFrame:
    """Sum of ``value`` per series and slot; partial sums are combined map-side."""
    return df.groupBy(*series, floor_to(ts, step).alias(out_ts)).agg(F.sum(value).alias(name))


def distinct_timestamps(df: DataFrame, ts: str, series: tuple[str, ...] = ()) -> DataFrame:
    """(series, ts) -> ``copies``; repeated timestamps collapse map-side before any ordering."""
    return df.groupBy(*series, ts).agg(F.count(F.lit(1)).alias("copies"))


def with_step(
    df: DataFrame,
    ts: str,
    series: tuple[str, ...] = (),
    name: str = "step_micros",
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
    plan_from: DataFrame | None = None,
) -> DataFrame:
    """Microseconds since the previous row of the series; null on the first."""

    def build(w):
        return {name: micros(ts) - F.lag(micros(ts)).over(w)}

    return ordered_windows(
        df, build, ts, series, before=1, chunk_rows=chunk_rows, slot=slot, plan_from=plan_from
    )


def continuity(
    df: DataFrame,
    ts: str = TS,
    step: int = HOUR,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """One row: number of intervals and how many differ from ``step``."""
    steps = with_step(df.select(*series, ts).dropna(subset=[ts]), ts, series, chunk_rows=chunk_rows, slot=slot)
    return steps.agg(
        F.count("step_micros").alias("intervals"),
        F.count_if(F.col("step_micros") != step).alias("unexpected_intervals"),
    )


def require_continuous(df: DataFrame, ts: str, step: int, series: tuple[str, ...] = (), stage: str = "series") -> None:
    bad = continuity(df, ts, step, series).first()["unexpected_intervals"]
    if bad:
        raise GuardError(f"{stage}: {bad} intervals differ from {step // MINUTE} minutes")


def gap_pieces(gaps: DataFrame, series: tuple[str, ...] = (), piece: int | None = None) -> DataFrame:
    """(series, series_start, __first, __last): gaps cut into pieces of at most ``piece`` grid points, dealt over all tasks.

    One wrong timestamp can make a gap of any length; its points then come from many tasks, each holding one piece at a time.
    """
    piece = piece or GAP_PIECE
    numbered = gaps.select(*series, "series_start", "__first", "__last", F.explode(F.expr(f"sequence(0L, (__last - __first) div {piece})")).alias("__piece"))
    tasks = int(gaps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartition(tasks, *series, "__first", "__piece")  # a stated number is not merged again, small as the rows are
    start = F.col("__first") + F.col("__piece") * piece
    return dealt.select(*series, "series_start", start.alias("__first"), F.least(F.col("__last"), start + (piece - 1)).alias("__last"))


def missing_intervals(
    df: DataFrame,
    ts: str = TS,
    step: int = 30 * MINUTE,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """Grid points (anchored at the first timestamp of the series) without a row.

    Only gaps are expanded; the full expected grid is never built. Work grows with the rows and with
    the missing points themselves.
    """
    require_columns(df, [*series, ts], "missing intervals")
    present = df.select(*series, ts).dropna(subset=[ts]).distinct()

    def build(w):
        return {"__next": F.lead(ts).over(w)}

    ahead = ordered_windows(
        present, build, ts, series, after=1, chunk_rows=chunk_rows, slot=slot, keep_series_start=True,
        plan_from=df,
    )
    # First and last grid number strictly between a timestamp and its successor.
    start = micros_sql("series_start")
    first = F.expr(f"({micros_sql(ts)} - {start}) div {step} + 1")
    last = F.expr(f"({micros_sql('__next')} - {start} - 1) div {step}")
    gaps = ahead.filter(F.col("__next").isNotNull()).withColumns({"__first": first, "__last": last})
    pieces = gap_pieces(gaps.filter("__first <= __last"), series)
    points = pieces.select(*series, "series_start", F.explode(F.sequence("__first", "__last")).alias("__k"))
    return points.select(*series, shift("series_start", f"__k * {step}L").alias(ts))


def upsample(
    df: DataFrame,
    linear: list[str],
    ts: str = TS,
    step: int = 30 * MINUTE,
    series: tuple[str, ...] = (),
    hold_next: list[str] | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """Rows every ``step`` between observations, ``linear`` columns interpolated over time.

    ``hold_next`` columns describe the period that ends at their timestamp: the observation also
    applies to the slot one step before it and is not interpolated. With ``hold_next`` only slots
    that carry both kinds of value are returned. Each row looks one row ahead, so no grid is joined.
    """
    hold = hold_next or []
    require_columns(df, [*series, ts, *linear, *hold], "up-sampling")
    narrow = df.select(*series, ts, *linear, *hold)

    def build(w):
        return {f"__n_{c}": F.lead(c).over(w) for c in [ts, *linear, *hold]}

    ahead = ordered_windows(narrow, build, ts, series, after=1, chunk_rows=chunk_rows, slot=slot)
    rows = ahead.withColumn("__span", F.expr(f"{micros_sql(f'__n_{ts}')} - {micros_sql(ts)}"))
    if hold:
        # Only the observation itself and the slot one step before the next one carry a held value.
        picks = f"if(__span > {step} and __span % {step} = 0, array(0L, __span div {step} - 1), array(0L))"
    else:
        picks = f"sequence(0L, coalesce(greatest((__span - 1) div {step}, 0L), 0L))"
    rows = rows.withColumn("__k", F.explode(F.expr(picks)))
    share = (F.col("__k") * step).cast("double") / F.col("__span")
    out = [
        F.when(F.col("__k") == 0, F.col(c)).otherwise(F.col(c) + (F.col(f"__n_{c}") - F.col(c)) * share).alias(c)
        for c in linear
    ]
    held = [F.when(F.col("__k") == 0, F.col(c)).otherwise(F.col(f"__n_{c}")).alias(c) for c in hold]
    return rows.select(*series, shift(ts, f"__k * {step}L").alias(ts), *out, *held)


def upsample_linear(df: DataFrame, columns: list[str], **options) -> DataFrame:
    return upsample(df, columns, **options)


def expand_backwards(
    df: DataFrame,
    value: str = "precipitation",
    ts: str = TS,
    step: int = 30 * MINUTE,
    series: tuple[str, ...] = (),
    flag_name: str = "is_raining",
) -> DataFrame:
    """Each observation at ``t`` also covers ``t - step``; an own observation beats a shifted one."""
    require_columns(df, [*series, ts, value], "expansion")
    both = F.array(
        F.struct(shift(ts, -step).alias("t"), F.lit(1).alias("moved")),
        F.struct(F.col(ts).alias("t"), F.lit(0).alias("moved")),
    )
    wide = df.select(*series, F.col(value).alias("__v"), F.explode(both).alias("__p"))
    kept = wide.groupBy(*series, F.col("__p.t").alias(ts)).agg(F.min_by("__v", F.col("__p.moved")).alias(value))
    return kept.withColumn(flag_name, flag(F.col(value) > 0))
