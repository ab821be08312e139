"""Order statistics, row positions, lags by time and distance, and order checks, against plain orderings."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from tempora.operators.ranges import MOST_BLOCKS, order_statistics, ranged_blocks, row_index
from tempora.operators.split import chronological_split, expanding_folds
from tempora.operators.windows import add_far_lags, add_lag_features, add_time_lags, order_check
from tempora.quality.reports import demand_report, training_report

START = dt.datetime(1969, 12, 31, 23, 59, 58)


def stamps(kind, n, rnd):
    if kind == "dense":
        return [START + dt.timedelta(microseconds=i) for i in range(n)]
    if kind == "same":
        return [START] * n
    if kind == "skew":  # most rows in one second, one row a century later
        return [START + dt.timedelta(microseconds=rnd.randrange(10**6)) for _ in range(n - 1)] + [START + dt.timedelta(days=36_500)]
    return [START + dt.timedelta(seconds=rnd.randrange(10**8)) for _ in range(n)]


@pytest.mark.parametrize("bins, leaf_rows", [(4096, 65_536), (7, 3), (2, 1)])
def test_order_statistics_equal_the_sorted_series(spark, bins, leaf_rows):
    rnd = random.Random(4)
    held = {k: stamps(k, n, rnd) for k, n in (("dense", 90), ("same", 40), ("skew", 60), ("wide", 75))} | {None: stamps("wide", 9, rnd), "empty": []}
    rows = [(k, t) for k, ts in held.items() for t in ts] + [("wide", None)] * 5 + [("empty", None)] * 2
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    ranks = lambda n: F.array(F.lit(0).cast("bigint"), F.floor(n / 3), n - 1, n, F.lit(-1).cast("bigint"), F.lit(17).cast("bigint"))
    got = {r["k"]: r["cuts"] for r in order_statistics(df, ranks, "ts", ("k",), bins, leaf_rows).collect()}
    for k, ts in held.items():
        n = len(ts) + sum(1 for key, t in rows if key == k and t is None)
        want = {i: sorted(ts)[r] for i, r in enumerate([0, n // 3, n - 1, n, -1, 17]) if 0 <= r < len(ts)}
        assert got.get(k, {}) == want, k
    alone = order_statistics(df.filter("k = 'skew'"), ranks, "ts", (), bins, leaf_rows).first()["cuts"]
    assert alone == got["skew"]
    assert order_statistics(df.limit(0), ranks, "ts", ("k",)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_splits_of_one_dense_series(spark):
    rows = [(START + dt.timedelta(microseconds=3 * i), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, i long").repartition(4)
    got = {r["i"]: r["split"] for r in chronological_split(df, 0.7, 0.15, "ts").collect()}
    assert all(got[i] == ("train" if i < 700 else "validation" if i < 850 else "test") for i in range(1000))
    folds = expanding_folds(df, 4, "ts").groupBy("fold", "role").count().collect()
    assert {(r["fold"], r["role"]): r["count"] for r in folds} == {(f, role): n for f in range(4) for role, n in (("train", 200 * (f + 1)), ("test", 200))}


@pytest.mark.parametrize("block_rows", [7, 50, 10_000])
@pytest.mark.parametrize("keys", [("k",), ()])
def test_positions_and_far_lags_equal_the_global_window(spark, keys, block_rows):
    rnd = random.Random(block_rows)
    rows = [(k, START + dt.timedelta(minutes=m), rnd.choice([None, *range(9)])) for k, n in (("hot", 150), ("a", 20), (None, 5)) if keys or k == "hot" for m in rnd.sample(range(10_000), n)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y long").repartition(3)
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("ts")
    want = df.withColumn("row_index", (F.row_number().over(w) - 1).cast("bigint"))
    assert row_index(df, "ts", keys, block_rows=block_rows).exceptAll(want).isEmpty()
    got = add_far_lags(df, [1, 30, 120], "y", "ts", keys, block_rows=block_rows)
    assert got.count() == len(rows) and got.exceptAll(add_lag_features(df, [1, 30, 120], target="y", ts="ts", series=keys)).isEmpty()


def test_lags_by_time_look_at_the_clock(frame):
    rows = [("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 01:00", 2.0), ("a", "2024-01-02 00:30", 3.0), ("a", "2024-01-02 01:00", None)]
    rows += [("b", "2024-01-01 01:00", 9.0), (None, "2024-01-01 00:00", 5.0), (None, "2024-01-01 01:00", 6.0), (None, None, 7.0)]
    df = frame("k string, ts timestamp_ntz, y double", rows)
    hour, day = 3600 * 10**6, 24 * 3600 * 10**6
    got = {(r["k"], str(r["ts"]), r["y"]): (r["h"], r["d"]) for r in add_time_lags(df, {"h": hour, "d": day}, "y", "ts", ("k",)).collect()}
    assert len(got) == len(rows)
    assert got["a", "2024-01-01 01:00:00", 2.0] == (1.0, None) and got["a", "2024-01-02 01:00:00", None] == (None, 2.0)
    assert got["b", "2024-01-01 01:00:00", 9.0] == (None, None) and got[None, "2024-01-01 01:00:00", 6.0] == (5.0, None)
    assert got[None, "None", 7.0] == (None, None) and got["a", "2024-01-02 00:30:00", 3.0] == (None, None)


@pytest.mark.parametrize("block_rows", [2, 9, 1000])
def test_order_of_uneven_positions(spark, block_rows):
    places = [2**i for i in range(55)] + [2**60 + i for i in range(40)]  # half the rows in a sliver of the range
    rows = [(p, f"f{p % 3}", START + dt.timedelta(hours=i)) for i, p in enumerate(places)]
    df = spark.createDataFrame(rows, "p long, f string, ts timestamp_ntz").repartition(3)
    assert order_check(df, "ts", "p", block_rows=block_rows).first()[0]
    assert ranged_blocks(df, ["p"], 10).groupBy("__block").count().agg(F.max("count")).first()[0] <= 30
    late = df.unionByName(spark.createDataFrame([(2**60 + 100, "f0", START)], df.schema))
    assert not order_check(late, "ts", "p", block_rows=block_rows).first()[0]
    assert not order_check(df, "ts", ["f", "p"], block_rows=block_rows).first()[0]  # by file, then place
    assert order_check(df, "ts", ["f", "p"], ("f",), block_rows).first()[0]


def test_reports_see_rows_out_of_order(spark):
    rows = [(START + dt.timedelta(minutes=30 * i), float(i), 1.0, -i) for i in range(40)]
    df = spark.createDataFrame(rows, "INTERVAL_DATETIME timestamp_ntz, OPERATIONAL_DEMAND double, x double, place long")
    assert demand_report(df, ordinal="place").first()["timestamp"]["is_monotonic_increasing"] is False
    report = training_report(df, ordinal="place").first()
    assert report["status"] == "FAIL" and "order" in " ".join(report["failures"])
    assert training_report(df.withColumn("place", -F.col("place")), ordinal="place").first()["status"] == "PASS"


def test_many_small_blocks_do_not_make_as_many_tasks(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("n"))
    assert ranged_blocks(df, ["n"], 1).select("__block").distinct().count() <= MOST_BLOCKS
    assert ranged_blocks(df, ["n"], 300).rdd.getNumPartitions() == 10
    indexed = row_index(df, "n", block_rows=1)
    assert indexed.count() == 3000 and indexed.filter("n <> row_index").isEmpty()
    assert order_check(df, "n", "n", block_rows=1).first()[0]
