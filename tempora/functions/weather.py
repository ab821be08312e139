"""Row-local weather features; the two temperature changes need ordered windows and are passed in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tempora.functions.casts import flag


def at_least_zero(c: Column) -> Column:
    """Clip below at zero, keeping nulls (``greatest`` alone would skip them)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def weather_columns(
    heating_base: float = 18.0,
    cooling_base: float = 22.0,
    hot_from: float = 30.0,
    humid_from: float = 80.0,
) -> dict[str, Column]:
    t, rh, rain = F.col("temperature"), F.col("relative_humidity"), F.col("precipitation")
    hot, humid = t >= hot_from, rh >= humid_from
    return {
        "heating_degree": at_least_zero(F.lit(float(heating_base)) - t),
        "cooling_degree": at_least_zero(t - F.lit(float(cooling_base))),
        "temperature_squared": t * t,
        "apparent_temperature_difference": F.col("apparent_temperature") - t,
        "temperature_humidity_interaction": t * rh,
        "is_high_temperature": flag(hot),
        "is_high_humidity": flag(humid),
        "is_hot_and_humid": flag(hot & humid),
        "is_daylight": flag(F.col("solar_radiation") > 0),
        "is_moderate_rain": flag(rain >= 1.0),
        "is_heavy_rain": flag(rain >= 5.0),
    }
