"""Calendar and cyclical features."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tempora.functions.casts import flag
from tempora.schemas import TS


def calendar_columns(ts: str = TS) -> dict[str, Column]:
    """Date parts; ``day_of_week`` counts from Monday = 0."""
    c = F.col(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.day(c),
        "day_of_week": F.weekday(c),
        "hour": F.hour(c),
        "minute": F.minute(c),
        "is_weekend": flag(F.weekday(c) >= 5).cast("int"),
    }


def _circle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclical_columns() -> dict[str, Column]:
    """Positions on the day, week and year circles, from the calendar columns."""
    time_of_day = F.col("hour") + F.col("minute") / F.lit(60.0)
    day = _circle(time_of_day, 24)
    week = _circle(F.col("day_of_week"), 7)
    year = _circle(F.col("month") - 1, 12)
    return {
        "time_of_day": time_of_day,
        "time_sin": day[0],
        "time_cos": day[1],
        "day_of_week_sin": week[0],
        "day_of_week_cos": week[1],
        "month_sin": year[0],
        "month_cos": year[1],
    }
