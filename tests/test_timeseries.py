import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tempora.errors import DataQualityError, GuardError
from tempora.functions.timeline import HOUR, MINUTE, floor_to, micros, shift, slot_id
from tempora.operators.timeseries import (
    continuity,
    expand_backwards,
    gap_pieces,
    missing_intervals,
    require_continuous,
    upsample,
    upsample_linear,
)
from tempora.plans.weather import clean_weather, weather_features
from tempora.schemas import CONTINUOUS_WEATHER, DERIVED_WEATHER_COLUMNS, HOURLY_VARIABLES, TS, WEATHER_COLUMNS

START = dt.datetime(2024, 1, 1)
RAW = "time string, " + ", ".join(f"{v} double" for v in HOURLY_VARIABLES)


def raw_weather(spark, n=6, start=START, **override):
    rows = []
    for i in range(n):
        row = {v: float(10 * j + i * i) for j, v in enumerate(HOURLY_VARIABLES)}
        row["precipitation"] = float(i % 3)
        row.update({k: f(i) for k, f in override.items() if k != "time"})
        time = override["time"](i) if "time" in override else (start + dt.timedelta(hours=i)).isoformat()
        rows.append((time, *[row[v] for v in HOURLY_VARIABLES]))
    return spark.createDataFrame(rows, RAW)


def test_timeline_helpers_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Australia/Melbourne")
    try:
        stamps = [dt.datetime(2024, 10, 6, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 4, 7, 2, 45, 1, 5)]
        df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
        got = df.select("t", micros("t").alias("m"), shift("t", -HOUR).alias("s"), slot_id("t", "second").alias("sec")).collect()
        for r in got:
            us = (r["t"] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            assert r["m"] == us and r["s"] == r["t"] - dt.timedelta(hours=1)
            assert r["sec"] == us // 1_000_000
        floors = df.select("t", floor_to("t", 30 * MINUTE).alias("f")).collect()
        assert all(r["f"] <= r["t"] < r["f"] + dt.timedelta(minutes=30) for r in floors)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("unit", ["month", "day", "hour", "minute", "second"])
def test_slot_ids_are_ordered(frame, unit):
    stamps = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-02-01 05:00:00"]
    got = frame("t timestamp_ntz", [(s,) for s in stamps]).orderBy("t").select(slot_id("t", unit)).collect()
    ids = [r[0] for r in got]
    assert ids == sorted(ids) and ids[0] < ids[-1]
    with pytest.raises(ValueError):
        slot_id("t", "week")


@pytest.mark.parametrize("chunk_rows", [2, 1000])
def test_missing_intervals_match_the_full_grid(spark, chunk_rows):
    rng = np.random.default_rng(3)
    grid = pd.date_range("2024-01-01", periods=400, freq="30min")
    keep = grid[np.sort(rng.choice(400, 150, replace=False))]
    df = spark.createDataFrame([("a", t.to_pydatetime()) for t in keep] * 2, "k string, ts timestamp_ntz")
    got = missing_intervals(df, "ts", series=("k",), chunk_rows=chunk_rows).toPandas()["ts"]
    want = pd.date_range(keep.min(), keep.max(), freq="30min").difference(keep)
    assert sorted(got) == list(want)


def test_missing_intervals_keep_the_anchor_with_off_grid_rows(frame):
    df = frame("ts timestamp_ntz", [("2024-01-01 00:00",), ("2024-01-01 00:10",), ("2024-01-01 01:00",)])
    got = [r["ts"].isoformat() for r in missing_intervals(df, "ts").collect()]
    assert got == ["2024-01-01T00:30:00"]


def test_missing_intervals_of_nothing(frame):
    df = frame("ts timestamp_ntz", [])
    assert missing_intervals(df, "ts").isEmpty()


def test_continuity(frame):
    stamps = ["2024-01-01 00:00", "2024-01-01 01:00", "2024-01-01 03:00"]
    df = frame("ts timestamp_ntz", [(s,) for s in stamps])
    assert continuity(df, "ts", HOUR).first().asDict() == {"intervals": 2, "unexpected_intervals": 1}
    with pytest.raises(GuardError, match="1 intervals"):
        require_continuous(df, "ts", HOUR)


@pytest.mark.parametrize("chunk_rows", [3, 1000])
def test_upsampling_matches_pandas(spark, chunk_rows):
    rng = np.random.default_rng(1)
    idx = pd.date_range("2024-01-01", periods=30, freq="h")
    pdf = pd.DataFrame({"ts": idx, "x": rng.normal(size=30)})
    df = spark.createDataFrame(pdf).selectExpr("cast(ts as timestamp_ntz) ts", "x")
    got = upsample_linear(df, ["x"], ts="ts", chunk_rows=chunk_rows).orderBy("ts").toPandas()
    want = pdf.set_index("ts").resample("30min").interpolate(method="time").reset_index()
    assert len(got) == 2 * 30 - 1
    assert list(got["ts"]) == list(want["ts"])
    np.testing.assert_allclose(got["x"], want["x"], atol=1e-12)


def test_upsampling_bridges_gaps_only_without_held_columns(frame):
    df = frame("ts timestamp_ntz, x double, p double", [("2024-01-01 00:00", 0.0, 1.0), ("2024-01-01 02:00", 4.0, 2.0)])
    assert [r["x"] for r in upsample(df, ["x"], "ts").orderBy("ts").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]
    both = upsample(df, ["x"], "ts", hold_next=["p"]).orderBy("ts").collect()
    assert [(r["ts"].hour, r["ts"].minute, r["x"], r["p"]) for r in both] == [(0, 0, 0.0, 1.0), (1, 30, 3.0, 2.0), (2, 0, 4.0, 2.0)]


def test_expansion_prefers_the_own_observation(frame):
    rows = [("2024-01-01 00:00", 0.0), ("2024-01-01 00:30", 2.0)]
    got = expand_backwards(frame("ts timestamp_ntz, p double", rows), "p", "ts").orderBy("ts").collect()
    assert [(r["ts"].strftime("%d %H:%M"), r["p"], r["is_raining"]) for r in got] == [
        ("31 23:30", 0.0, 0),
        ("01 00:00", 0.0, 0),
        ("01 00:30", 2.0, 1),
    ]


def test_clean_weather(spark):
    out = clean_weather(raw_weather(spark))
    assert out.columns == [TS, *WEATHER_COLUMNS]
    got = out.orderBy(TS).toPandas()
    assert len(got) == 11 and got[TS].iloc[0] == pd.Timestamp(START)
    # The half hour before each observation carries that observation's rain.
    assert list(got["precipitation"]) == [0, 1, 1, 2, 2, 0, 0, 1, 1, 2, 2]
    assert list(got["temperature"][:3]) == [0.0, 0.5, 1.0]
    assert dict(out.dtypes)["is_raining"] == "tinyint"


@pytest.mark.parametrize(
    "override, message",
    [
        ({"time": lambda i: (START + dt.timedelta(hours=i + (i > 2))).isoformat()}, "apart"),
        ({"time": lambda i: (START + dt.timedelta(hours=min(i, 3))).isoformat()}, "more than once"),
        ({"temperature_2m": lambda i: None if i == 1 else 1.0}, "missing"),
        ({"temperature_2m": lambda i: float("nan") if i == 1 else 1.0}, "missing"),
    ],
)
def test_clean_weather_refuses(spark, override, message):
    with pytest.raises(DataQualityError, match=message):
        clean_weather(raw_weather(spark, **override))


def test_clean_weather_strict_parsing_and_columns(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_weather(raw_weather(spark, time=lambda i: "yesterday"))
    with pytest.raises(GuardError, match="temperature"):
        clean_weather(raw_weather(spark).drop("temperature_2m"))


def test_weather_features(frame):
    names = ["temperature", "relative_humidity", "apparent_temperature", "precipitation", "solar_radiation"]
    schema = f"{TS} timestamp_ntz, " + ", ".join(f"{n} double" for n in names) + ", is_raining int"
    rows = [
        ("2024-01-01 00:00", 10.0, 80.0, 8.0, 0.0, 0.0, 0),
        ("2024-01-01 00:30", 30.0, 79.0, 33.0, 1.0, 5.0, 1),
        ("2024-01-01 01:00", None, 90.0, 1.0, 5.0, None, 1),
        ("2024-01-01 01:30", 35.0, 81.0, 36.0, 4.9, 1.0, 1),
    ]
    got = weather_features(frame(schema, rows)).orderBy(TS).collect()
    assert got[0].asDict().keys() >= set(DERIVED_WEATHER_COLUMNS)
    assert [r["heating_degree"] for r in got] == [8.0, 0.0, None, 0.0]
    assert [r["cooling_degree"] for r in got] == [0.0, 8.0, None, 13.0]
    assert [r["temperature_change_1h"] for r in got] == [None, None, None, 5.0]
    assert [r["is_high_temperature"] for r in got] == [0, 1, 0, 1]
    assert [r["is_high_humidity"] for r in got] == [1, 0, 1, 1]
    assert [r["is_hot_and_humid"] for r in got] == [0, 0, 0, 1]
    assert [r["is_daylight"] for r in got] == [0, 1, 0, 1]
    assert [r["is_moderate_rain"] for r in got] == [0, 1, 1, 1]
    assert [r["is_heavy_rain"] for r in got] == [0, 0, 1, 0]
    assert len(CONTINUOUS_WEATHER) == 6


def test_long_gaps_come_in_pieces_from_many_tasks(spark):
    gaps = spark.createDataFrame([("a", 5, 10**8 + 4), ("b", 7, 7), ("c", 1, 250)], "k string, __first long, __last long")
    gaps = gaps.withColumn("series_start", F.lit("2024-01-01").cast("timestamp_ntz"))
    pieces = gap_pieces(gaps, ("k",), 100_000).withColumn("n", F.expr("__last - __first + 1")).withColumn("task", F.spark_partition_id())
    got = {r["k"]: (r["pieces"], r["points"], r["longest"], r["lo"], r["hi"]) for r in pieces.groupBy("k").agg(F.count("*").alias("pieces"), F.sum("n").alias("points"), F.max("n").alias("longest"), F.min("__first").alias("lo"), F.max("__last").alias("hi")).collect()}
    assert got == {"a": (1000, 10**8, 100_000, 5, 10**8 + 4), "b": (1, 1, 1, 7, 7), "c": (1, 250, 250, 1, 250)}
    assert pieces.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_gap_pieces_do_not_change_the_points(spark, monkeypatch):
    monkeypatch.setattr("tempora.operators.timeseries.GAP_PIECE", 3)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m),) for m in (0, 30, 700, 735, 2000)], "ts timestamp_ntz")
    got = sorted(r["ts"] for r in missing_intervals(df, "ts").collect())
    grid = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * k) for k in range(1, 67)]
    here = {r["ts"] for r in df.collect()}
    assert got == [t for t in grid if t not in here and t < dt.datetime(2024, 1, 1) + dt.timedelta(minutes=2000)]
