"""Guards, casts, duplicates, joins, set operations."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tempora.errors import GuardError
from tempora.functions.calendar import calendar_columns, cyclical_columns
from tempora.functions.casts import lenient_double, lenient_timestamp, strict_double
from tempora.functions.weather import at_least_zero
from tempora.operators import columns as c
from tempora.operators import dedup, joins, setops
from tempora.plans.demand import clean_demand
from tempora.schemas import TS, WEATHER_COLUMNS


def values(df, *by):
    return [tuple(r) for r in df.orderBy(*(by or df.columns)).collect()]


def test_lenient_timestamps(frame):
    texts = ["2024/01/02 03:04:05", "2024/1/2 3:4:5", "2024-01-02 03:04:05", "2024/13/01 00:00:00", "", None]
    got = frame("t string", [(t,) for t in texts]).select(lenient_timestamp("t").alias("t")).collect()
    good = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert [r["t"] for r in got] == [good, good, None, None, None, None]


def test_lenient_numbers(frame):
    texts = ["1", " -2.5 ", "1e3", ".5", "1d", "0x10", "NaN", "abc", "", None, "inf"]
    got = [r[0] for r in frame("t string", [(t,) for t in texts]).select(lenient_double("t")).collect()]
    assert got == [1.0, -2.5, 1000.0, 0.5, None, None, None, None, None, None, math.inf]


def test_strict_numbers_raise(frame):
    assert frame("t string", [("2",), ("NaN",)]).select(strict_double("t").alias("v")).collect() == [(2.0,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame("t string", [("x",)]).select(strict_double("t")).collect()


def test_guards(frame):
    df = frame("a int, b double, s string", [(1, 2.0, "x"), (None, float("nan"), "y")])
    with pytest.raises(GuardError, match=r"\['p', 'q'\]"):
        c.require_columns(df, ["q", "a", "p"])
    with pytest.raises(GuardError, match="no rows"):
        c.require_rows(df.limit(0))
    with pytest.raises(GuardError, match="'b': 1"):
        c.require_no_missing(df, ["a", "b", "s"])
    assert c.non_numeric_columns(df, df.columns) == ["s"]
    assert c.numeric_columns(df) == ["a", "b"]
    assert c.feature_columns(df, "a", "s") == ["b"]
    assert values(c.rows_with_missing(df, ["b"]).select("s")) == [("y",)]
    assert c.count_all_missing(df, ["a", "b"]).first()[0] == 1
    assert c.drop_missing(df).count() == 1
    assert c.replace_nan(df).filter("b is null").count() == 1


def test_filter_series_names_what_exists(frame):
    df = frame("REGIONID string, v int", [("A", 1), ("B", 2)])
    assert values(c.filter_series(df, "B")) == [("B", 2)]
    with pytest.raises(GuardError, match="there are 2 others, from 'A' to 'B'"):
        c.filter_series(df, "Z", require_match=True)


def test_clip_keeps_nulls(frame):
    got = frame("x double", [(-1.0,), (2.0,), (None,)]).select(at_least_zero(F.col("x"))).collect()
    assert [r[0] for r in got] == [0.0, 2.0, None]


def test_calendar_monday_is_zero(frame):
    df = frame(f"{TS} timestamp_ntz", [("2024-01-01 06:30",), ("2024-01-06 00:00",), ("2024-01-07 12:00",)])
    got = df.withColumns(calendar_columns()).withColumns(cyclical_columns()).orderBy(TS).collect()
    assert [r["day_of_week"] for r in got] == [0, 5, 6]
    assert [r["is_weekend"] for r in got] == [0, 1, 1]
    assert got[0]["time_of_day"] == 6.5
    assert got[0]["time_sin"] == pytest.approx(math.sin(2 * math.pi * 6.5 / 24))
    assert got[2]["day_of_week_cos"] == pytest.approx(math.cos(2 * math.pi * 6 / 7))
    assert (got[0]["month_sin"], got[0]["month_cos"]) == (0.0, 1.0)


CORRECTIONS = "REGIONID string, INTERVAL_DATETIME int, LASTCHANGED int, v string, SOURCE_FILE string, _line int"


def latest(df):
    out = dedup.latest_per_key(df, ("REGIONID", "INTERVAL_DATETIME"), "LASTCHANGED", ("SOURCE_FILE", "_line"))
    return [r["v"] for r in out.orderBy("REGIONID", "INTERVAL_DATETIME").collect()]


def test_latest_correction(frame):
    rows = [
        ("A", 1, 5, "old", "f", 1),
        ("A", 1, 9, "new", "f", 2),
        ("A", 2, 9, "known", "f", 3),
        ("A", 2, None, "unknown change time wins", "f", 4),
        ("A", 3, 9, "first", "f1", 5),
        ("A", 3, 9, "later file", "f2", 1),
        ("A", 4, 9, "line 1", "f", 1),
        ("A", 4, 9, "line 2", "f", 2),
        (None, None, 1, "null key a", "f", 1),
        (None, None, 2, "null key b", "f", 2),
    ]
    got = latest(frame(CORRECTIONS, rows))
    assert got == ["null key b", "new", "unknown change time wins", "later file", "line 2"]


def test_exact_duplicates_keep_their_first_position(frame):
    # A, B, A again: the repeated A must not count as newer than B.
    rows = [("K", 1, 9, "A", "f", 1), ("K", 1, 9, "B", "f", 2), ("K", 1, 9, "A", "f", 3)]
    unique = dedup.drop_exact_duplicates(frame(CORRECTIONS, rows), "_line")
    assert sorted((r["v"], r["_line"]) for r in unique.collect()) == [("A", 1), ("B", 2)]
    assert latest(unique) == ["B"]


def test_duplicates_count_nulls_as_equal(frame):
    df = frame("k int, j int", [(1, 1), (1, 1), (None, 1), (None, 1), (None, None)])
    assert dedup.duplicate_count(df, ["k"]).first()[0] == 3
    assert dedup.duplicate_count(df, ["k", "j"]).first()[0] == 2
    assert dedup.duplicate_count(df.limit(0), ["k"]).first()[0] == 0


def test_clean_demand(frame):
    schema = (
        "REGIONID string, INTERVAL_DATETIME string, OPERATIONAL_DEMAND string, OPERATIONAL_DEMAND_ADJUSTMENT string,"
        " WDR_ESTIMATE string, LASTCHANGED string, SOURCE_FILE string"
    )
    a = ("A", "2024/01/01 00:30:00", "10", "0", "x", "2024/01/01 01:00:00", "f")
    b = ("A", "2024/01/01 00:30:00", "11", "0", "0", "2024/01/01 02:00:00", "f")
    other = ("B", "2024/01/01 00:30:00", "7", "0", "0", "2024/01/01 02:00:00", "f")
    df = frame(schema, [a, a, b, other])
    got = clean_demand(df, "A").collect()
    assert len(got) == 1 and got[0]["OPERATIONAL_DEMAND"] == 11.0
    assert clean_demand(df).count() == 2
    with pytest.raises(GuardError, match="OPERATIONAL_DEMAND"):
        clean_demand(frame(schema, [(*a[:2], "n/a", *a[3:])]), "A")
    with pytest.raises(GuardError, match="there are .* others"):
        clean_demand(df, "C")
    with pytest.raises(GuardError, match="LASTCHANGED"):
        clean_demand(df.drop("LASTCHANGED"))


def test_upsert(frame):
    base = frame("k int, v int", [(1, 1), (2, 2)])
    assert values(dedup.upsert(base, frame("k int, v int", [(2, 9), (3, 9)]), ["k"])) == [(1, 1), (2, 9), (3, 9)]


def weather_rows(frame, stamps, gap=None):
    schema = f"{TS} timestamp_ntz, " + ", ".join(f"{w} double" for w in WEATHER_COLUMNS)
    rows = [(s, *[None if gap == (s, w) else 1.0 for w in WEATHER_COLUMNS]) for s in stamps]
    return frame(schema, rows)


T = [f"2024-01-01 0{i}:00" for i in range(5)]


def test_attach_weather(frame):
    demand = frame(f"{TS} timestamp_ntz, d int", [(t, i) for i, t in enumerate(T[:3])])
    full = joins.attach_weather(demand, weather_rows(frame, T), on_unmatched="error")
    assert full.count() == 3 and full.columns == [TS, "d", *WEATHER_COLUMNS]
    short = weather_rows(frame, T[1:])
    assert joins.attach_weather(demand, short).filter("temperature is null").count() == 1
    with pytest.raises(GuardError, match="1 rows have no weather"):
        joins.attach_weather(demand, short, on_unmatched="error")
    with pytest.raises(GuardError, match="0 rows have no weather and 1"):
        joins.attach_weather(demand, weather_rows(frame, T, (T[0], "wind_speed")), on_unmatched="error")
    with pytest.raises(GuardError, match="repeated"):
        joins.attach_weather(demand.union(demand), short)
    with pytest.raises(GuardError, match="repeated"):
        joins.attach_weather(demand, short.union(short))
    with pytest.raises(GuardError, match="no rows"):
        joins.attach_weather(demand.limit(0), short)
    with pytest.raises(GuardError, match="missing key"):
        joins.attach_weather(frame(f"{TS} timestamp_ntz, d int", [(None, 1)]), short)
    with pytest.raises(ValueError):
        joins.attach_weather(demand, short, on_unmatched="ignore")


def test_key_coverage(frame):
    left = frame("k int", [(1,), (1,), (2,), (None,)])
    right = frame("k int", [(2,), (3,), (4,), (None,)])
    assert joins.key_coverage(left, right, ["k"]).first().asDict() == {
        "left_keys": 2, "right_keys": 3, "matched": 1, "unmatched": 1, "extra": 2, "match_rate": 0.5,
    }
    assert joins.key_coverage(left.limit(0), right, ["k"]).first()["match_rate"] == 0.0
    assert values(joins.unmatched_keys(left, right, ["k"])) == [(1,)]
    assert values(joins.unmatched_keys(right, left, ["k"])) == [(3,), (4,)]


def test_split_overlap(frame):
    parts = {n: frame("k int", [(i,) for i in v]) for n, v in {"a": [1, 2, 2], "b": [2, 3], "c": [3, 2]}.items()}
    assert joins.split_overlap(parts, ["k"]).first().asDict() == {"a_b": 1, "a_c": 1, "b_c": 2}


def test_set_operations(frame):
    a, b = frame("x int, y int", [(1, 1)]), frame("y int, z int", [(2, 3)])
    assert values(setops.union_by_name([a, b]), F.col("y")) == [(1, 1, None), (None, 2, 3)]
    v = frame("k string", [("a",), ("b",), ("b",), ("c",), (None,)])
    assert [tuple(r) for r in setops.value_counts(v, "k").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert setops.value_counts(v, "k", top=1).count() == 1
    assert values(setops.distinct_values(v, "k")) == [("a",), ("b",), ("c",)]
    top = setops.top_k(frame("f string, i int", [("a", 1), ("b", 3), ("c", 3)]), "i", 2, "f")
    assert [r["f"] for r in top.collect()] == ["b", "c"]
