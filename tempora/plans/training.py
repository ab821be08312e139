"""The training table: demand features joined with weather, warm-up removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tempora.operators.chunks import CHUNK_ROWS, SLOT
from tempora.operators.columns import drop_missing, model_columns, require_columns, require_rows
from tempora.operators.joins import attach_weather, require_unique
from tempora.plans.demand import demand_features
from tempora.schemas import LAGS, ROLLING_WINDOWS, TARGET, TS


def prepare_training(df: DataFrame, ts: str = TS, series: tuple[str, ...] = (), check: bool = True) -> DataFrame:
    """Unique timestamps, no missing values, at least one row."""
    require_columns(df, [*series, ts], "training table")
    if check:
        require_unique(df, [*series, ts], "training table")
    out = drop_missing(df)
    if check:
        require_rows(out, "training table")
    return out


def training_table(
    demand: DataFrame,
    weather: DataFrame,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    weather_keys: list[str] | None = None,
    weather_columns: list[str] | None = None,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING_WINDOWS,
    on_unmatched: str = "report",
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
    check: bool = False,
) -> DataFrame:
    """Cleaned demand and weather to a model-ready table.

    ``weather_columns`` defaults to the eight basic ones; pass the derived ones as well to keep them.
    """
    features = demand_features(
        model_columns(demand, series, ts, target), ts, target, series, lags, windows, chunk_rows, slot, check
    )
    merged = attach_weather(features, weather, weather_keys or [ts], weather_columns, on_unmatched, check)
    ordered = merged.select(*features.columns, *[c for c in merged.columns if c not in features.columns])
    return prepare_training(ordered, ts, series, check)
