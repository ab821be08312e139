"""Zone-free arithmetic on ``TIMESTAMP_NTZ`` columns.

Casting to ``TIMESTAMP`` would route through the session zone and can reorder values around DST
changes; these helpers only use field extraction and interval addition.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def micros_sql(ts: str) -> str:
    c = quoted(ts)
    return (
        f"(unix_date(cast({c} as date)) * {DAY}L + hour({c}) * {HOUR}L + minute({c}) * {MINUTE}L"
        f" + cast(extract(second from {c}) * {SECOND} as bigint))"
    )


def micros(ts: str) -> Column:
    """Microseconds since 1970-01-01 00:00 on the column's own timeline."""
    return F.expr(micros_sql(ts))


def shift(ts: str, amount: int | str) -> Column:
    """``ts`` moved by microseconds: a number, or an SQL expression for one."""
    us = f"cast({amount} as bigint)"
    days = f"cast(({us} - pmod({us}, {DAY}L)) div {DAY}L as int)"
    seconds = f"cast(cast(pmod({us}, {DAY}L) as decimal(18,0)) / {SECOND} as decimal(18,6))"
    return F.expr(f"{quoted(ts)} + make_dt_interval({days}, 0, 0, {seconds})")


def floor_to(ts: Column | str, step: int) -> Column:
    """Start of the ``step``-microsecond slot of ``ts`` (slots align to 1970-01-01); rows without one are dropped."""
    return F.window(ts, f"{step} microseconds").getField("start")


def slot_id(ts: Column | str, unit: str) -> Column:
    """Ordered integer naming the calendar slot of ``ts``; null stays null."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if unit == "month":
        return (F.year(c) * 12 + F.month(c)).cast("bigint")
    day = F.unix_date(c.cast("date")).cast("bigint")
    if unit == "day":
        return day
    if unit == "hour":
        return day * 24 + F.hour(c)
    if unit == "minute":
        return (day * 24 + F.hour(c)) * 60 + F.minute(c)
    if unit == "second":
        return ((day * 24 + F.hour(c)) * 60 + F.minute(c)) * 60 + F.second(c)
    raise ValueError(f"unknown slot unit: {unit}")
