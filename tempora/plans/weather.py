"""Weather: cleaning to the demand grid and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tempora.functions.casts import flag, strict_double, strict_timestamp
from tempora.functions.timeline import MINUTE
from tempora.functions.weather import weather_columns
from tempora.operators.chunks import CHUNK_ROWS, SLOT
from tempora.operators.columns import require_columns, require_no_missing
from tempora.operators.timeseries import require_continuous, upsample
from tempora.operators.windows import add_differences
from tempora.quality.reports import enforce, hourly_weather_report
from tempora.schemas import CONTINUOUS_WEATHER, DERIVED_WEATHER_COLUMNS, TS, WEATHER_RENAMES

RAIN = "precipitation"


def type_weather(df: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """Rename and cast strictly; unreadable values raise."""
    renamed = df.withColumnsRenamed(WEATHER_RENAMES)
    require_columns(renamed, [*series, TS, *CONTINUOUS_WEATHER, RAIN], "weather cleaning")
    return renamed.select(
        *series, strict_timestamp(TS).alias(TS), *[strict_double(c).alias(c) for c in [*CONTINUOUS_WEATHER, RAIN]]
    )


def clean_weather(
    df: DataFrame,
    series: tuple[str, ...] = (),
    step: int = 30 * MINUTE,
    require_regular: bool = True,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """Hourly observations on a half-hour grid.

    Continuous variables are interpolated; precipitation covers the two half hours that end at its
    hour. Both come from one look at the next row, so there is no second frame to join.
    ``require_regular`` refuses repeated, missing or irregular input, and irregular output.
    """
    typed = type_weather(df, series)
    if require_regular:
        enforce(hourly_weather_report(typed, [*CONTINUOUS_WEATHER, RAIN], 2 * step, TS, series, chunk_rows, slot))
    half = upsample(typed, CONTINUOUS_WEATHER, TS, step, series, [RAIN], chunk_rows, slot)
    out = half.withColumn("is_raining", flag(F.col(RAIN) > 0))
    if require_regular:
        require_no_missing(out, out.columns, "weather output")
        require_continuous(out, TS, step, series, "weather output")
    return out


def weather_features(
    df: DataFrame,
    ts: str = TS,
    series: tuple[str, ...] = (),
    heating_base: float = 18.0,
    cooling_base: float = 22.0,
    hot_from: float = 30.0,
    humid_from: float = 80.0,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """The 13 derived features; changes over 1 h and 3 h are 2 and 6 half-hour rows back."""
    require_columns(
        df,
        [*series, ts, "temperature", "relative_humidity", "apparent_temperature", RAIN, "solar_radiation", "is_raining"],
        "weather features",
    )
    changes = {"temperature_change_1h": 2, "temperature_change_3h": 6}
    ordered = add_differences(df, "temperature", changes, ts, series, chunk_rows, slot)
    full = ordered.withColumns(weather_columns(heating_base, cooling_base, hot_from, humid_from))
    return full.select(*df.columns, *DERIVED_WEATHER_COLUMNS)
