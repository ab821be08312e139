"""Demand: cleaning and feature chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tempora.functions.calendar import calendar_columns, cyclical_columns
from tempora.operators.chunks import CHUNK_ROWS, SLOT
from tempora.operators.columns import (
    coerce_demand_types,
    filter_series,
    require_columns,
    require_no_missing,
)
from tempora.operators.dedup import drop_exact_duplicates, latest_per_key
from tempora.operators.windows import add_history_features
from tempora.schemas import CHANGED, DEMAND_NUMERIC_COLUMNS, LAGS, ROLLING_WINDOWS, SERIES, SOURCE_FILE, TARGET, TS
from tempora.sources.tagged import POSITION


def clean_demand(df: DataFrame, region: str | None = None, check: bool = True, keep_position: bool = False) -> DataFrame:
    """Typed, de-duplicated demand: one row per (series, timestamp), the latest correction wins.

    ``region=None`` keeps all series; they are processed side by side. The ingest position, when present,
    breaks ties between equally recent corrections; it is dropped afterwards, unless ``keep_position`` asks for it: with
    the source file it is the order that ``demand_report`` can check.
    """
    needed = [SERIES, TS, *DEMAND_NUMERIC_COLUMNS, CHANGED, SOURCE_FILE]
    require_columns(df, needed, "demand cleaning")
    picked = df if region is None else filter_series(df, region, SERIES, require_match=check)
    position = POSITION if POSITION in df.columns else None
    typed = coerce_demand_types(picked)
    unique = drop_exact_duplicates(typed, position)
    ties = (SOURCE_FILE, position) if position else (SOURCE_FILE,)
    latest = latest_per_key(unique, (SERIES, TS), CHANGED, ties)
    if not keep_position:
        latest = latest.drop(POSITION)
    if check:
        require_no_missing(latest, [TS, TARGET], "demand cleaning")
    return latest


def demand_features(
    df: DataFrame,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING_WINDOWS,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
    check: bool = False,
) -> DataFrame:
    """Calendar, lag, rolling and cyclical features, in this column order; one ordered shuffle."""
    if check:
        require_no_missing(df, [ts], "calendar features")
    history = add_history_features(df, lags, windows, target, ts, series, chunk_rows, slot)
    past = [c for c in history.columns if c not in df.columns]
    dated = history.withColumns(calendar_columns(ts))
    calendar = list(calendar_columns(ts))
    full = dated.withColumns(cyclical_columns())
    return full.select(*df.columns, *calendar, *past, *cyclical_columns())
