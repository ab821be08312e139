"""Several series at once: shared weather, split order inside each series, order of uneven positions, tree limits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tempora.errors import GuardError
from tempora.models.trees import boosting_estimator, fit_random_forest
from tempora.operators.joins import attach_weather
from tempora.operators.split import chronological_split, split_part
from tempora.operators.windows import order_check
from tempora.quality import reports
from tempora.schemas import SERIES, TARGET, TS

START = dt.datetime(2024, 1, 1)


def panel(spark, spans):
    rows = [(name, START + dt.timedelta(minutes=30 * k), float(k + 1)) for name, (a, b) in spans.items() for k in range(a, b)]
    return spark.createDataFrame(rows, f"{SERIES} string, {TS} timestamp_ntz, {TARGET} double")


def test_series_share_one_weather_series(spark):
    demand = panel(spark, {"A": (0, 4), "B": (2, 6)})
    weather = spark.createDataFrame([(START + dt.timedelta(minutes=30 * k), float(k)) for k in range(5)], f"{TS} timestamp_ntz, temperature double")
    merged = attach_weather(demand, weather, columns=["temperature"], demand_keys=[SERIES, TS])
    assert merged.count() == 8 and merged.columns == [SERIES, TS, TARGET, "temperature"]
    report = reports.merge_report(demand, weather, merged, columns=["temperature"], demand_keys=[SERIES, TS]).first()
    assert (report["duplicate_merged_timestamp_count"], report["unmatched_demand_timestamp_count"]) == (0, 1)
    with pytest.raises(GuardError, match="repeated"):
        attach_weather(demand, weather, columns=["temperature"])
    with pytest.raises(GuardError, match="repeated"):
        attach_weather(demand, weather.unionByName(weather), columns=["temperature"], demand_keys=[SERIES, TS])
    with pytest.raises(GuardError, match="1 rows have no weather"):
        attach_weather(demand, weather, columns=["temperature"], demand_keys=[SERIES, TS], on_unmatched="error")


def test_split_order_is_judged_inside_each_series(spark):
    full = panel(spark, {"A": (0, 40), "B": (300, 380)})
    labelled = chronological_split(full, series=(SERIES,))
    parts = [split_part(labelled, p) for p in ("train", "validation", "test")]
    good = reports.split_report(full, *parts, features=[], keys=(SERIES,)).first()
    assert good["status"] == "PASS" and good["full_row_count"] == 120
    assert reports.split_report(full, *parts, features=[]).first()["failures"] == ["Training does not end before validation.", "Validation does not end before test."]
    late = full.where(f"{SERIES} = 'B' AND {TARGET} = 380")
    bad = reports.split_report(full, parts[0].unionByName(late), *parts[1:], features=["zz"], keys=(SERIES,)).first()
    assert {"Training does not end before validation.", "The parts share timestamps.", "Some features do not exist."} < set(bad["failures"])


def test_order_of_sparse_positions(spark):
    rows = spark.range(3000).select((F.col("id") * 1_000_003).alias("position"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,id)").alias("t"), (F.col("id") % 2).alias("g"))
    assert order_check(rows, "t", "position", block_rows=100).first()[0]
    back = F.when(F.col("position") == 2500 * 1_000_003, F.expr("t - interval 1 hour")).otherwise(F.col("t"))
    assert not order_check(rows.withColumn("t", back), "t", "position", block_rows=100).first()[0]
    # Groups that follow each other in position but not in time are in order, each for itself.
    turned = rows.withColumn("t", F.when(F.col("g") == 1, F.expr("t - interval 10 days")).otherwise(F.col("t")))
    assert order_check(turned, "t", "position", ("g",), 100).first()[0] and not order_check(turned, "t", "position", (), 100).first()[0]
    assert order_check(rows.limit(0), "t", "position").first()[0]


def test_tree_requests_are_not_changed_in_silence(frame):
    df = frame("a double, y double", [(1.0, 1.0), (2.0, 3.0)])
    with pytest.raises(GuardError, match="max_depth"):
        fit_random_forest(df, ["a"], "y", max_depth=31)
    for odd in ({"max_depth": 31}, {"reg_alpha": 0.5}, {"gamma": 0.0}):
        with pytest.raises(GuardError):
            boosting_estimator(odd)
