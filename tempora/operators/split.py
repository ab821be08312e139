"""Chronological train / validation / test split and expanding folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tempora.errors import GuardError
from tempora.operators.chunks import attach_cuts
from tempora.operators.columns import require_columns
from tempora.operators.joins import require_unique
from tempora.operators.ranges import order_statistics
from tempora.schemas import TRAIN_RATIO, TS, VALIDATION_RATIO


def _truncated_share(n: Column, ratio: float) -> Column:
    # Binary floating point, then truncation: 90 rows at 0.70 give 62.
    return F.floor(n.cast("double") * F.lit(float(ratio))).cast("bigint")


def chronological_split(
    df: DataFrame,
    train_ratio: float = TRAIN_RATIO,
    validation_ratio: float = VALIDATION_RATIO,
    ts: str = TS,
    series: tuple[str, ...] = (),
    check: bool = False,
) -> DataFrame:
    """Add ``split``: the earliest rows train, then validation, the rest test, per series.

    Timestamps are unique per series, so positions turn into two cut timestamps and the label is a
    comparison: no global row numbering and no sort of the data.
    """
    require_columns(df, [*series, ts], "split")
    if not 0 < train_ratio < 1 or not 0 < validation_ratio < 1:
        raise GuardError("split ratios must lie strictly between 0 and 1")
    if 1 - train_ratio - validation_ratio <= 0:
        raise GuardError("split ratios leave nothing for the test part")
    if check:
        require_unique(df, [*series, ts], "split")

    def ranks(n: Column) -> Column:
        train_end = _truncated_share(n, train_ratio)
        return F.array(train_end, train_end + _truncated_share(n, validation_ratio))

    cuts = order_statistics(df, ranks, ts, series)
    rows = attach_cuts(df, cuts, series)
    t, first, second = F.col(ts), F.try_element_at("cuts", F.lit(0)), F.try_element_at("cuts", F.lit(1))
    label = F.when(t < first, "train").when(t < second, "validation").otherwise("test")
    out = rows.withColumn("split", label).select(*df.columns, "split")
    if check:
        seen = {r["split"] for r in out.select("split").distinct().collect()}
        if len(seen) < 3:
            raise GuardError(f"split: only {sorted(seen)} contain rows")
    return out


def split_part(df: DataFrame, *parts: str) -> DataFrame:
    """Rows of the named parts; two names give the union used for the final fit."""
    return df.filter(F.col("split").isin(*parts)).drop("split")


def _fold_ranks(n_splits: int) -> Callable[[Column], Column]:
    def ranks(n: Column) -> Column:
        size = F.floor(n / F.lit(n_splits + 1)).cast("bigint")
        return F.array(*[n - F.lit(n_splits - i) * size for i in range(n_splits)])

    return ranks


def fold_blocks(df: DataFrame, n_splits: int = 4, ts: str = TS, series: tuple[str, ...] = ()) -> DataFrame:
    """Add ``block``: fold f of :func:`expanding_folds` trains on the blocks up to f and is tested on block f + 1.

    Each row once, whatever the number of folds. Series with fewer than ``n_splits + 1`` rows have no folds and no rows here.
    """
    require_columns(df, [*series, ts], "folds")
    if n_splits < 2:
        raise GuardError("folds: at least two are needed")
    rows = attach_cuts(df, order_statistics(df, _fold_ranks(n_splits), ts, series), series)
    starts = [F.try_element_at("cuts", F.lit(i)) for i in range(n_splits)]
    passed = sum((F.coalesce((F.col(ts) >= s).cast("int"), F.lit(0)) for s in starts), F.lit(0))
    return rows.filter(F.col(ts).isNotNull() & starts[0].isNotNull()).withColumn("block", passed).select(*df.columns, "block")


def expanding_folds(
    df: DataFrame, n_splits: int = 4, ts: str = TS, series: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``fold`` and ``role``: fold i trains on everything before its test block.

    The test blocks are the last ``n_splits`` blocks of ``n // (n_splits + 1)`` rows; a row appears
    once per fold it takes part in. Series with fewer than ``n_splits + 1`` rows have no folds.
    """
    require_columns(df, [*series, ts], "folds")
    if n_splits < 2:
        raise GuardError("folds: at least two are needed")

    rows = attach_cuts(df, order_statistics(df, _fold_ranks(n_splits), ts, series), series)
    member = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.try_element_at("cuts", F.col("fold"))
    end = F.try_element_at("cuts", F.col("fold") + 1)
    last = F.col("fold") == n_splits - 1
    role = F.when(F.col(ts) < start, "train").when((F.col(ts) >= start) & (last | (F.col(ts) < end)), "test")
    return member.withColumn("role", role).filter(F.col("role").isNotNull()).select(*df.columns, "fold", "role")
