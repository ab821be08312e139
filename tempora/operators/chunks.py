"""Row-ordered windows over series of any length.

``Window.partitionBy(series)`` puts a whole series into one task, and without series columns the
whole table. Series of at most ``chunk_rows`` rows keep that plan. A longer series is cut into
consecutive chunks of about ``chunk_rows`` rows, each of which also receives the neighbouring rows its
windows look at (the halo), and the window is partitioned by ``(series, chunk)``: a single long or hot
series spreads over the cluster, with results identical to the global window.

How it is planned:

1. Rows per series, one map-side-combined aggregate over the series columns alone. Usually nothing is
   longer than ``chunk_rows`` and the plain window follows.
2. For the long series only: rows per calendar slot, from which chunk borders and halos are derived.
   This slot table is stored and counted. It is bounded by (number of long series) x (time span /
   slot width), and broadcast only below ``BROADCAST_ROWS``; beyond that it is shuffle-joined.
3. One shuffle of the rows by ``(series, chunk)``.

A slot is never split. Days are tried first; while the fullest slot exceeds ``chunk_rows``, the next
finer unit is counted instead, down to seconds. On a 30-minute grid a day holds at most 48 rows; with
distinct microsecond timestamps a second holds at most one million rows. Callers that allow repeated
timestamps reduce them to distinct ones first. The input is read by each of these steps; store an
expensive input first, or name the frame to count with ``plan_from``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tempora.errors import GuardError
from tempora.functions.timeline import slot_id
from tempora.operators.columns import require_columns
from tempora.session import materialise, sized

CHUNK_ROWS = 250_000
SLOT = "day"
SLOT_UNITS = ["month", "day", "hour", "minute", "second"]

_SLOT, _ROWS, _START, _CHUNK, _CORE = "__slot", "__rows", "__start", "__chunk", "__core"
_MIN, _TOTAL = "__min_ts", "__total"


def slot_counts(df: DataFrame, ts: str, series: tuple[str, ...], slot: str = SLOT) -> DataFrame:
    """Per (series, slot): rows, offset of its first row in the series, series total and first timestamp."""
    per_series = Window.partitionBy(*(series or [F.lit(0)]))
    ordered = per_series.orderBy(F.col(_SLOT).asc_nulls_last())
    counted = df.groupBy(*series, slot_id(ts, slot).alias(_SLOT)).agg(
        F.count(F.lit(1)).alias(_ROWS), F.min(ts).alias(_MIN)
    )
    return counted.select(
        *series,
        _SLOT,
        _ROWS,
        (F.sum(_ROWS).over(ordered) - F.col(_ROWS)).alias(_START),
        F.sum(_ROWS).over(per_series).alias(_TOTAL),
        F.min(_MIN).over(per_series).alias(_MIN),
    )


def fitted_counts(
    df: DataFrame, ts: str, series: tuple[str, ...], slot: str, rows_per_slot: int
) -> tuple[DataFrame, str]:
    """Stored slot counts at the coarsest unit, from ``slot`` on, whose fullest slot is small enough."""
    units = SLOT_UNITS[SLOT_UNITS.index(slot) :]
    for unit in units:
        counts = materialise(slot_counts(df, ts, series, unit), "slot-counts")
        fullest = counts.agg(F.max(_ROWS)).first()[0]
        if unit == units[-1] or fullest is None or fullest <= rows_per_slot:
            break
    return counts, unit


def long_series(df: DataFrame, series: tuple[str, ...], chunk_rows: int) -> DataFrame | None:
    """Rows belonging to series longer than ``chunk_rows``; None when there is no such series."""
    if not series:
        return df if df.count() > chunk_rows else None
    counts = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    long = counts.filter(F.col("__n") > chunk_rows).select(*series)
    if long.isEmpty():
        return None
    return null_safe_join(df, sized(long, "long-series"), series, "left_semi")


def chunk_assignment(
    counts: DataFrame, series: tuple[str, ...], before: int, after: int, chunk_rows: int
) -> DataFrame:
    """(series, slot) -> every chunk that needs the slot, with ``__core`` marking its own chunk.

    Slot offsets are contiguous, so "the slot ends within ``before`` rows of a later chunk's first
    row" is a RANGE frame over the offsets, seen from the next slot; the mirrored frame serves
    ``after``. Both frames read the small slot table only.
    """
    counts = counts.withColumn(_CHUNK, F.expr(f"{_START} div {int(chunk_rows)}"))
    per_series = Window.partitionBy(*(series or [F.lit(0)]))
    by_start = per_series.orderBy(_START)
    targets = F.array(_CHUNK)
    if before:
        ahead = counts.withColumn(
            "__ahead", F.collect_set(_CHUNK).over(by_start.rangeBetween(Window.currentRow, before - 1))
        )
        counts = ahead.withColumn("__ahead", F.lead("__ahead").over(by_start))
        targets = F.array_union(targets, F.coalesce(F.col("__ahead"), F.array().cast("array<bigint>")))
    if after:
        behind = counts.withColumn("__prev", F.lag(_CHUNK).over(by_start))
        counts = behind.withColumn(
            "__behind", F.collect_set("__prev").over(by_start.rangeBetween(-(after - 1), Window.currentRow))
        )
        targets = F.array_union(targets, F.coalesce(F.col("__behind"), F.array().cast("array<bigint>")))
    own = counts.select(*series, _SLOT, _MIN, F.col(_CHUNK).alias("__own"), F.explode(targets).alias(_CHUNK))
    return own.select(*series, _SLOT, _MIN, _CHUNK, (F.col(_CHUNK) == F.col("__own")).alias(_CORE))


def join_on_slot(
    df: DataFrame, slots: DataFrame, ts: str, series: tuple[str, ...], slot: str, how: str = "inner"
) -> DataFrame:
    """Attach slot-level columns to the rows; null-safe, so rows without a timestamp are kept."""
    return null_safe_join(df.withColumn(_SLOT, slot_id(ts, slot)), slots, (*series, _SLOT), how)


def ordered_windows(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    ts: str,
    series: tuple[str, ...] = (),
    before: int = 0,
    after: int = 0,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
    keep_series_start: bool = False,
    plan_from: DataFrame | None = None,
) -> DataFrame:
    """Add the columns returned by ``build(window)``, where ``window`` orders one series by ``ts``.

    ``before``/``after`` state how many rows the expressions look back and ahead.
    ``chunk_rows=None`` skips the length check and uses the plain per-series window: for panels whose
    series are known to be short. ``keep_series_start`` also returns the series' first timestamp.
    ``plan_from`` is a cheaper frame to count, for windows that reach one row: it holds the same
    timestamps, possibly repeated.
    """
    require_columns(df, [*series, ts], "ordered windows")
    if chunk_rows is None and not series:
        raise GuardError("a frame without series columns needs chunk_rows")
    if chunk_rows is not None and chunk_rows < max(before, after, 1):
        raise GuardError(f"chunk_rows={chunk_rows} is smaller than the window reach")
    counted = (df if plan_from is None else plan_from).select(*series, ts)
    long = None if chunk_rows is None else long_series(counted, series, chunk_rows)
    rows, partition = df, [*series] or [F.lit(0)]
    if long is not None:
        counts, slot = fitted_counts(long, ts, series, slot, chunk_rows)
        slots = sized(chunk_assignment(counts, series, before, after, chunk_rows), "slots")
        # Rows of short series find no slot: they form one chunk of their own.
        rows = join_on_slot(df, slots, ts, series, slot, "left")
        partition = [*series, _CHUNK]
    added = build(Window.partitionBy(*partition).orderBy(F.col(ts).asc_nulls_last()))
    if keep_series_start:
        first = F.min(ts).over(Window.partitionBy(*partition))
        added["series_start"] = first if long is None else F.coalesce(F.col(_MIN), first)
    out = rows.withColumns(added)
    if long is not None:
        out = out.filter(F.coalesce(F.col(_CORE), F.lit(True)))
    return out.select(*df.columns, *added)


def null_safe_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "left") -> DataFrame:
    """Equi-join that also matches null keys, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def attach_cuts(df: DataFrame, cuts: DataFrame, series: tuple[str, ...]) -> DataFrame:
    """Rows with the ``cuts`` of their series; a scalar subquery when there is one series."""
    if series:
        return null_safe_join(df, sized(cuts, "cuts"), series, "left")
    return df.withColumn("cuts", cuts.scalar())
