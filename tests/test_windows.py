"""Chunked windows equal plain windows, and the row-based semantics of the history features."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tempora.errors import GuardError
from tempora.operators.chunks import fitted_counts, ordered_windows
from tempora.operators.timeseries import missing_intervals
from tempora.operators.windows import (
    add_differences,
    add_history_features,
    add_lag_features,
    add_rolling_features,
    complete_windows_only,
    lag_expressions,
    order_check,
    rolling_expressions,
)

START = dt.datetime(2024, 1, 1)


def series(spark, sizes, gap=0.2, seed=1, step=30):
    rnd = random.Random(seed)
    rows = []
    for key, n in sizes.items():
        t = START
        for _ in range(n):
            rows.append((key, t, rnd.choice([None, *range(50)]) if gap else rnd.randrange(50)))
            t += dt.timedelta(minutes=step * (1 if rnd.random() > gap else rnd.randrange(1, 200)))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, y long")


@pytest.mark.parametrize("keys", [("k",), ()])
@pytest.mark.parametrize("chunk_rows", [60, 97, 1000])
def test_chunks_equal_the_global_window(spark, keys, chunk_rows):
    # One series holds most of the rows.
    df = series(spark, {"hot": 700, "a": 40, "b": 3} if keys else {"hot": 700}).cache()
    got = add_history_features(df, [1, 2, 48], [4, 48], "y", "ts", keys, chunk_rows=chunk_rows)
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("ts")
    want = df.withColumns({**lag_expressions("y", [1, 2, 48])(w), **rolling_expressions("y", [4, 48])(w)})
    want = complete_windows_only(want, [4, 48])
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), chunk_rows=st.integers(5, 40), reach=st.integers(1, 5))
def test_halo_property(spark, seed, chunk_rows, reach):
    df = series(spark, {"a": 150, "b": 30}, seed=seed, gap=0.5)

    def build(w):
        return {"back": F.lag("ts", reach).over(w), "ahead": F.lead("ts", reach).over(w)}

    got = ordered_windows(df, build, "ts", ("k",), reach, reach, chunk_rows)
    want = df.withColumns(build(Window.partitionBy("k").orderBy("ts")))
    assert got.count() == 180 and got.exceptAll(want).isEmpty()


def test_a_slot_larger_than_a_chunk(spark):
    # 600 rows inside one day, followed by sparse days: later chunks still see their halo.
    rows = [("a", START + dt.timedelta(minutes=i), i) for i in range(600)]
    rows += [("a", START + dt.timedelta(days=1 + i), 1000 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y long")
    got = add_lag_features(df, [1, 20], target="y", ts="ts", series=("k",), chunk_rows=20)
    w = Window.partitionBy("k").orderBy("ts")
    assert got.exceptAll(df.withColumns(lag_expressions("y", [1, 20])(w))).isEmpty()
    assert got.count() == 630


def test_full_slots_are_counted_at_a_finer_unit(spark):
    rows = [("a", START + dt.timedelta(seconds=7 * i), i) for i in range(900)]
    rows += [("a", START + dt.timedelta(days=2 + i), i) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y long")
    counts, unit = fitted_counts(df, "ts", ("k",), "day", 50)
    assert unit == "minute" and counts.count() == 105 + 9
    assert fitted_counts(df, "ts", ("k",), "day", 1000)[1] == "day"
    assert fitted_counts(df, "ts", ("k",), "day", 0)[1] == "second"
    got = add_lag_features(df, [1, 20], target="y", ts="ts", series=("k",), chunk_rows=50)
    w = Window.partitionBy("k").orderBy("ts")
    assert got.exceptAll(df.withColumns(lag_expressions("y", [1, 20])(w))).isEmpty() and got.count() == 909


def test_repeated_timestamps_may_fill_a_slot(spark):
    # A third of the rows share one timestamp; gaps are still exact with chunks smaller than that.
    stamps = [START + dt.timedelta(hours=2 * i) for i in range(60)] + [START + dt.timedelta(hours=40)] * 30
    df = spark.createDataFrame([("a", t) for t in stamps], "k string, ts timestamp_ntz")
    got = missing_intervals(df, "ts", 3600 * 10**6, ("k",), chunk_rows=10)
    assert sorted(r["ts"] for r in got.collect()) == [START + dt.timedelta(hours=2 * i + 1) for i in range(59)]


def test_plain_and_chunked_agree_and_null_keys_survive(spark):
    df = spark.createDataFrame(
        [(None, START, 1), (None, START + dt.timedelta(hours=1), 2), ("a", START, 3), ("a", None, 4)],
        "k string, ts timestamp_ntz, y long",
    )
    options = dict(target="y", ts="ts", series=("k",))
    chunked = add_lag_features(df, [1], **options)
    plain = add_lag_features(df, [1], chunk_rows=None, **options)
    assert sorted(map(str, chunked.collect())) == sorted(map(str, plain.collect()))
    assert chunked.count() == 4


def test_matches_pandas(spark):
    values = [5, 3, None, 8, 1, 9, 2, 2, 7, 4]
    rows = [(START + dt.timedelta(minutes=30 * i), None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, y double")
    got = add_history_features(df, [1, 3], [4], "y", "ts").orderBy("ts").toPandas()
    y = pd.Series(values, dtype=float)
    past = y.shift(1).rolling(4, min_periods=4)
    np.testing.assert_array_equal(got["lag_3"], y.shift(3))
    for name in ("mean", "std", "min", "max"):
        np.testing.assert_allclose(got[f"rolling_{name}_4"], getattr(past, name)(), atol=1e-12)


def test_lags_are_row_offsets_across_gaps(frame):
    df = frame("ts timestamp_ntz, y int", [("2024-01-01 00:00", 1), ("2024-03-01 00:00", 2)])
    got = add_lag_features(df, [1], target="y", ts="ts").orderBy("ts").collect()
    assert [r["lag_1"] for r in got] == [None, 1]


def test_differences(frame):
    df = frame("ts timestamp_ntz, y double", [(f"2024-01-01 0{i}:00", float(i * i)) for i in range(4)])
    got = add_differences(df, "y", {"d2": 2}, ts="ts").orderBy("ts").collect()
    assert [r["d2"] for r in got] == [None, None, 4.0, 8.0]


@pytest.mark.parametrize("bad", [[], [0], [-1], [1.5], [True]])
def test_lag_arguments(spark, bad):
    df = spark.createDataFrame([(START, 1)], "ts timestamp_ntz, y int")
    with pytest.raises(GuardError):
        add_lag_features(df, bad, target="y", ts="ts")
    with pytest.raises(GuardError):
        add_rolling_features(df, bad, target="y", ts="ts")


def test_window_guards(spark):
    df = spark.createDataFrame([(START, 1)], "ts timestamp_ntz, y int")
    with pytest.raises(GuardError):
        add_lag_features(df, [50], target="y", ts="ts", chunk_rows=10)
    with pytest.raises(GuardError):
        add_lag_features(df, [1], target="y", ts="ts", chunk_rows=None)
    with pytest.raises(GuardError, match="absent"):
        add_lag_features(df, [1], target="nope", ts="ts")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [("k",), ()])
def test_plan_depends_on_the_longest_series(spark, keys, monkeypatch):
    df = series(spark, {"a": 50}, gap=0)
    options = dict(target="y", ts="ts", series=keys)
    assert "__chunk" not in plan_of(add_lag_features(df, [1], **options))
    long = plan_of(add_lag_features(df, [1], chunk_rows=10, **options))
    assert "__chunk" in long and "BroadcastHashJoin" in long
    monkeypatch.setattr("tempora.session.BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = add_lag_features(df, [1], chunk_rows=10, **options)
        assert "SortMergeJoin" in plan_of(shuffled)
        assert shuffled.exceptAll(add_lag_features(df, [1], **options)).isEmpty() and shuffled.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("block_rows", [2, 3, 100])
def test_order_check(frame, block_rows):
    def verdict(stamps):
        rows = [(i, s) for i, s in enumerate(stamps)]
        df = frame("i long, ts timestamp_ntz", rows)
        return order_check(df, "ts", "i", block_rows=block_rows).first()[0]

    ok = ["2024-01-01 00:00", "2024-01-01 00:00", "2024-01-02 00:00", "2024-01-03 00:00", "2024-01-03 01:00"]
    assert verdict(ok)
    assert not verdict([*ok, "2024-01-03 00:30"])
    assert not verdict([ok[2], ok[0], *ok[3:]])
    assert not verdict([*ok[:2], None, *ok[2:]])
