"""Lag, rolling and difference features, and order checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tempora.errors import GuardError
from tempora.functions.timeline import shift
from tempora.operators.chunks import CHUNK_ROWS, SLOT, null_safe_join, ordered_windows
from tempora.operators.columns import require_columns
from tempora.operators.ranges import ranged_blocks, row_index
from tempora.schemas import LAGS, ROLLING_WINDOWS, TARGET, TS
from tempora.session import materialise

Build = Callable[[WindowSpec], dict[str, Column]]


def _positive(values: Sequence[int], what: str) -> list[int]:
    if not values:
        raise GuardError(f"{what}: at least one value is needed")
    wrong = [v for v in values if isinstance(v, bool) or not isinstance(v, int) or v < 1]
    if wrong:
        raise GuardError(f"{what}: positive integers expected, got {wrong}")
    return list(values)


def lag_expressions(target: str, lags: Sequence[int]) -> Build:
    return lambda w: {f"lag_{k}": F.lag(target, k).over(w) for k in lags}


def rolling_expressions(target: str, windows: Sequence[int]) -> Build:
    """Statistics of the preceding ``n`` rows and how many of these rows hold a value."""

    def build(w: WindowSpec) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for n in windows:
            frame = w.rowsBetween(-n, -1)
            for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
                out[f"rolling_{name}_{n}"] = fn(target).over(frame)
            out[f"__values_{n}"] = F.count(target).over(frame)
        return out

    return build


def complete_windows_only(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Null out statistics of windows that are not filled; the count is evaluated once per window."""
    masked = {
        f"rolling_{name}_{n}": F.when(F.col(f"__values_{n}") == n, F.col(f"rolling_{name}_{n}"))
        for n in windows
        for name in ("mean", "std", "min", "max")
    }
    return df.withColumns(masked).drop(*[f"__values_{n}" for n in windows])


def add_history_features(
    df: DataFrame,
    lags: Sequence[int] | None = LAGS,
    windows: Sequence[int] | None = ROLLING_WINDOWS,
    target: str = TARGET,
    ts: str = TS,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """Lags and rolling statistics together, sharing one shuffle and one sort."""
    require_columns(df, [*series, ts, target], "history features")
    builders: list[Build] = []
    reach = 0
    if lags is not None:
        reach = max([reach, *_positive(lags, "lags")])
        builders.append(lag_expressions(target, lags))
    if windows is not None:
        reach = max([reach, *_positive(windows, "rolling windows")])
        builders.append(rolling_expressions(target, windows))

    def build(w: WindowSpec) -> dict[str, Column]:
        return {name: column for b in builders for name, column in b(w).items()}

    out = ordered_windows(df, build, ts, series, before=reach, chunk_rows=chunk_rows, slot=slot)
    return complete_windows_only(out, windows) if windows is not None else out


def add_lag_features(df: DataFrame, lags: Sequence[int] = LAGS, **options) -> DataFrame:
    """Target values ``k`` rows earlier (row offsets, not time offsets)."""
    return add_history_features(df, lags=lags, windows=None, **options)


def add_rolling_features(df: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS, **options) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of the preceding rows, current row excluded."""
    return add_history_features(df, lags=None, windows=windows, **options)


def add_differences(
    df: DataFrame,
    column: str,
    names: dict[str, int],
    ts: str = TS,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """``column`` minus its value ``k`` rows earlier, one output per ``{name: k}``."""
    require_columns(df, [*series, ts, column], "differences")
    reach = max(_positive(list(names.values()), "differences"))

    def build(w: WindowSpec) -> dict[str, Column]:
        return {name: F.col(column) - F.lag(column, k).over(w) for name, k in names.items()}

    return ordered_windows(df, build, ts, series, before=reach, chunk_rows=chunk_rows, slot=slot)


def add_time_lags(df: DataFrame, lags: dict[str, int], target: str = TARGET, ts: str = TS, series: tuple[str, ...] = ()) -> DataFrame:
    """The target's value exactly so many microseconds earlier, one output per ``{name: distance}``; null where no row stands.

    An equi-join on moved timestamps: any distance costs the same, and no series is ordered. All distances share one
    aggregate by (series, ts). Where a timestamp repeats, the largest value counts. Rows without a timestamp keep nulls.
    """
    require_columns(df, [*series, ts, target], "time lags")
    _positive(list(lags.values()), "time lags")
    names = list(lags)
    which = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(lags[n]).cast("bigint").alias("far")) for i, n in enumerate(names)]))
    moved = df.filter(F.col(ts).isNotNull()).select(*series, F.col(ts).alias("__ts"), F.col(target).alias("__y"), which.alias("__lag"))
    moved = moved.withColumn("__at", shift("__ts", "__lag.far").cast(df.schema[ts].dataType))
    return _attach_lags(df, moved, names, series, F.col(ts), "__at")


def add_far_lags(
    df: DataFrame, lags: Sequence[int], target: str = TARGET, ts: str = TS, series: tuple[str, ...] = (), block_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Target values ``k`` rows earlier, for any ``k``: an equi-join on the rows' positions, so no halo has to be carried along.

    Equals ``add_lag_features``, which is cheaper as long as the reach is small against ``chunk_rows``.
    """
    require_columns(df, [*series, ts, target], "far lags")
    ks = _positive(lags, "lags")
    indexed = materialise(row_index(df, ts, series, "__index", block_rows), "far-lags")
    which = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).cast("bigint").alias("far")) for i, k in enumerate(ks)]))
    moved = indexed.select(*series, "__index", F.col(target).alias("__y"), which.alias("__lag")).withColumn("__at", F.col("__index") + F.col("__lag.far"))
    return _attach_lags(indexed, moved, [f"lag_{k}" for k in ks], series, F.col("__index"), "__at").drop("__index")


def _attach_lags(df: DataFrame, moved: DataFrame, names: list[str], series: tuple[str, ...], key: Column, at: str) -> DataFrame:
    values = [F.max(F.when(F.col("__lag.i") == i, F.col("__y"))).alias(n) for i, n in enumerate(names)]
    found = moved.groupBy(*series, F.col(at).alias("__key")).agg(*values)
    return null_safe_join(df.withColumn("__key", key), found, (*series, "__key"), "left").select(*df.columns, *names)


def order_check(
    df: DataFrame, ts: str, ordinal: str | Sequence[str], group: tuple[str, ...] = (), block_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Is ``ts`` non-decreasing in the order of ``ordinal``, inside each group? False when any value is missing.

    ``ordinal`` is an ingest position, of one column or several, dense or not. Rows are dealt into blocks at sampled quantiles of
    it: order inside a block is checked by a window over that block, and blocks are compared through their smallest and
    largest value, one row per block.
    """
    places = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    named = [f"__ordinal_{i}" for i in range(len(places))]
    rows = df.select(*group, *[F.col(c).alias(n) for c, n in zip(places, named, strict=True)], F.col(ts).alias("__ts"))
    inside = Window.partitionBy(*group, "__block").orderBy(*named)
    blocks = (
        ranged_blocks(rows, named, block_rows)
        .withColumn("__back", F.col("__ts") < F.lag("__ts").over(inside))
        .groupBy(*group, "__block")
        .agg(
            F.count_if("__back").alias("__backs"),
            F.count_if(F.col("__ts").isNull()).alias("__nulls"),
            F.min("__ts").alias("__lo"),
            F.max("__ts").alias("__hi"),
        )
    )
    across = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    steps = blocks.withColumn("__back", F.col("__lo") < F.max("__hi").over(across))
    return steps.agg(
        (
            F.coalesce(F.sum("__backs"), F.lit(0)) + F.coalesce(F.sum("__nulls"), F.lit(0)) + F.count_if("__back") == 0
        ).alias("is_monotonic_increasing")
    )
