import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tempora.errors import DataQualityError, GuardError
from tempora.quality import profiles, reports
from tempora.schemas import TARGET, TS, WEATHER_COLUMNS
from tempora.sinks.reports import plain, report_dict
from tempora.sinks.tables import read_csv_like, write_csv, write_merge_details

T = [f"2024-01-01 {i:02d}:00" for i in range(6)]
INF = float("inf")
NAN = float("nan")


def row(df):
    return report_dict(df)


def test_timestamp_profile(frame):
    stamps = [T[0], T[1], T[1], T[1], T[3], None, None]
    df = frame("i int, ts timestamp_ntz", list(enumerate(stamps)))
    got = row(profiles.timestamp_profile(df, "ts", ordinal="i"))
    # Three valid repeats count twice, the second missing value once.
    assert got == {
        "invalid_timestamp_count": 2,
        "duplicate_timestamp_count": 3,
        "is_monotonic_increasing": False,
        "minimum_timestamp": "2024-01-01T00:00:00",
        "maximum_timestamp": "2024-01-01T03:00:00",
        "most_common_intervals": {"0 days 00:00:00": 2, "0 days 01:00:00": 1, "0 days 02:00:00": 1},
    }


def test_timestamp_profile_of_nothing(frame):
    got = row(profiles.timestamp_profile(frame("ts timestamp_ntz", []), "ts"))
    assert got["minimum_timestamp"] is None and got["most_common_intervals"] == {}
    assert got["invalid_timestamp_count"] == 0 and got["is_monotonic_increasing"] is True


@pytest.mark.parametrize("ordered", [True, False])
def test_profile_order_comes_from_the_ordinal(frame, ordered):
    stamps = T[:3] if ordered else T[:3][::-1]
    df = frame("i int, ts timestamp_ntz", list(enumerate(stamps)))
    assert row(profiles.timestamp_profile(df, "ts", ordinal="i"))["is_monotonic_increasing"] is ordered


def test_interval_text(spark):
    us = [30 * 60 * 10**6, (26 * 3600 + 61) * 10**6 + 5]
    got = spark.createDataFrame([(u,) for u in us], "u long").select(profiles.interval_text("u")).collect()
    assert [r[0] for r in got] == ["0 days 00:30:00", "1 days 02:01:01.000005"]


def test_null_and_infinite_counts(frame):
    df = frame("a double, b int, s string", [(NAN, None, "x"), (INF, 1, None), (-INF, 2, "y"), (1.0, 3, "z")])
    assert {r[0]: r[1] for r in profiles.null_counts(df).collect()} == {"a": 1, "b": 1, "s": 1}
    assert [tuple(r) for r in profiles.infinite_counts(df).collect()] == [("a", 2)]


def demand(frame, values, stamps=T):
    return frame(f"{TS} timestamp_ntz, {TARGET} string", list(zip(stamps, values)))


def test_demand_report(frame):
    good = row(reports.demand_report(demand(frame, ["1", "0", "-2.5"])))
    assert good["status"] == "PASS" and good["failures"] == []
    assert good["target"] == {
        "missing_or_non_numeric_count": 0, "infinite_count": 0, "non_positive_count": 2,
        "minimum": -2.5, "maximum": 1.0, "mean": -0.5,
    }
    bad = row(reports.demand_report(demand(frame, ["x", "inf", "1"], [T[0], T[0], None])))
    assert bad["status"] == "FAIL" and len(bad["failures"]) == 4
    empty = row(reports.demand_report(demand(frame, [])))
    assert empty["failures"] == ["The demand frame has no rows."] and empty["target"]["mean"] is None
    with pytest.raises(GuardError):
        reports.demand_report(frame("x int", [(1,)]))


def test_demand_report_parses_text_timestamps(frame):
    df = frame(f"{TS} string, {TARGET} double", [("2024/01/01 00:00:00", 1.0), ("soon", 2.0)])
    assert row(reports.demand_report(df))["timestamp"]["invalid_timestamp_count"] == 1


def test_enforce_saves_then_raises(frame, spark, tmp_path):
    path = str(tmp_path / "r.json")
    with pytest.raises(DataQualityError, match="more than once") as caught:
        reports.enforce(reports.demand_report(demand(frame, ["1", "2"], [T[0], T[0]])), path)
    saved = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    assert saved["status"] == "FAIL" and saved["failures"] == caught.value.failures
    assert reports.enforce(reports.demand_report(demand(frame, ["1"])), path)["status"] == "PASS"


def test_weather_report_counts_nulls_but_fails_on_infinity(frame):
    schema = f"{TS} timestamp_ntz, a double, b double"
    ok = row(reports.weather_report(frame(schema, [(T[0], None, 1.0), (T[1], NAN, 1.0)])))
    assert ok["status"] == "PASS" and ok["missing_value_count"] == 2 and ok["missing_values_by_column"] == {"a": 2}
    assert ok["weather_feature_count"] == 2 and ok["column_count"] == 3
    bad = row(reports.weather_report(frame(schema, [(T[0], INF, 1.0)])))
    assert bad["status"] == "FAIL" and bad["infinite_values_by_column"] == {"a": 1}


def weather(frame, stamps, skip=None):
    names = [w for w in WEATHER_COLUMNS if w != skip]
    return frame(f"{TS} timestamp_ntz, " + ", ".join(f"{w} double" for w in names), [(s, *[1.0] * len(names)) for s in stamps])


def merged(d, w):
    return d.join(w, TS, "left")


def test_merge_report_statuses(frame):
    d = frame(f"{TS} timestamp_ntz, d int", [(t, 1) for t in T])
    full = weather(frame, T)
    ok = row(reports.merge_report(d, full, merged(d, full)))
    assert ok["status"] == "PASS" and ok["match_rate"] == 1.0 and ok["warnings"] == []
    short = weather(frame, T[:-1])
    warned = row(reports.merge_report(d, short, merged(d, short), minimum_match_rate=0.5))
    assert warned["status"] == "PASS_WITH_WARNINGS" and len(warned["warnings"]) == 2
    assert warned["missing_weather_value_count_after_merge"] == 8
    failed = row(reports.merge_report(d, short, merged(d, short)))
    assert failed["status"] == "FAIL" and failed["unmatched_demand_timestamp_count"] == 1
    twice = full.unionByName(full)
    grown = row(reports.merge_report(d, twice, merged(d, twice)))
    assert grown["row_difference_vs_demand"] == 6 and len(grown["failures"]) == 2
    lost = row(reports.merge_report(d, full, merged(d, full).limit(3)))
    assert lost["warnings"] == ["The merge lost demand rows."]
    partial = weather(frame, T, skip="wind_speed")
    assert row(reports.merge_report(d, partial, merged(d, partial)))["status"] == "FAIL"


def test_merge_details(frame, spark, tmp_path):
    d = frame(f"{TS} timestamp_ntz, d int", [(t, 1) for t in T[:3]])
    w = weather(frame, T[1:])
    write_merge_details(d, w, merged(d, w), str(tmp_path))
    sizes = {p: spark.read.option("header", True).csv(f"{tmp_path}/{p}").count() for p in
             ("unmatched_demand_timestamps", "extra_weather_timestamps", "merged_rows_with_missing_weather")}
    assert list(sizes.values()) == [1, 3, 1]


def test_training_report(frame):
    schema = f"{TS} timestamp_ntz, {TARGET} double, f double"
    ok = row(reports.training_report(frame(schema, [(T[0], 1.0, 2.0), (T[1], 1.0, 2.0)])))
    assert ok["status"] == "PASS" and ok["feature_columns"] == ["f"] and ok["feature_count"] == 1
    bad = row(reports.training_report(frame(f"{schema}, s string", [(T[0], None, INF, "x"), (T[0], 1.0, 1.0, "y")])))
    assert len(bad["failures"]) == 4 and bad["non_numeric_features"] == ["s"]
    bare = row(reports.training_report(frame(f"{TS} timestamp_ntz, {TARGET} double", [])))
    assert len(bare["failures"]) == 2


def test_training_report_order(frame):
    df = frame(f"i int, {TS} timestamp_ntz, {TARGET} double", [(0, T[1], 1.0), (1, T[0], 1.0)])
    assert row(reports.training_report(df, ordinal="i"))["failures"] == ["Training timestamps are out of order."]


def test_split_report(frame):
    def part(stamps):
        return frame(f"{TS} timestamp_ntz, {TARGET} int", [(s, 1) for s in stamps])

    full = part(T)
    ok = row(reports.split_report(full, part(T[:3]), part(T[3:4]), part(T[4:]), []))
    assert ok["status"] == "PASS" and ok["boundaries"]["train_end"] == "2024-01-01T02:00:00"
    bad = row(reports.split_report(full, part(T[:4]), part(T[3:4]), part([]), [TS, TARGET, "gone"]))
    assert bad["status"] == "FAIL" and len(bad["failures"]) == 8
    assert bad["timestamp_overlap_counts"] == {"train_validation": 1, "train_test": 0, "validation_test": 0}
    assert bad["missing_feature_columns"] == ["gone"]


def test_model_output_report(frame):
    board = frame("model string, MAE double, RMSE double, MAPE double, R2 double", [("a", 1.0, 1.0, 1.0, 1.0)])
    good = frame("actual double, predicted double, residual double", [(1.0, 1.0, 0.0)])
    numbers = board.drop("model")
    ok = row(reports.model_output_report(board, good, numbers, "a"))
    assert ok["status"] == "PASS" and ok["finite_test_metrics"]["MAE"] is True
    nan = frame("MAE double, RMSE double, MAPE double, R2 double", [(NAN, 1.0, 1.0, 1.0)])
    worse = frame("actual double, predicted double, residual double", [(1.0, None, None), (1.0, INF, 1.0)])
    bad = row(reports.model_output_report(board.drop("R2"), worse, nan, "z"))
    assert len(bad["failures"]) == 5
    assert bad["non_finite_prediction_counts"] == {"predicted": 2, "residual": 1}
    empty = row(reports.model_output_report(board, good.limit(0), numbers, "a"))
    assert empty["failures"] == ["There are no test predictions."]


def test_series_report(frame, spark):
    df = frame(f"REGIONID string, {TS} timestamp_ntz, v int", [("A", T[0], 1), ("A", T[2], None), ("A", T[2], 1)])
    got = row(reports.series_report(df))
    assert (got["rows"], got["duplicate_intervals"], got["missing_interval_count"]) == (3, 1, 3)
    table = spark.read.option("header", True).csv(got["missing_interval_table"])
    assert [r[0][:19] for r in table.orderBy(TS).collect()] == ["2024-01-01T00:30:00", "2024-01-01T01:00:00", "2024-01-01T01:30:00"][: table.count()] and table.count() == 3
    assert got["missing_values"] == {"REGIONID": 0, TS: 0, "v": 1}


def test_plain_values():
    value = {1: (dt.timedelta(minutes=30), NAN, dt.datetime(2024, 1, 1)), "ü": None}
    assert plain(value) == {"1": ["0:30:00", None, "2024-01-01T00:00:00"], "ü": None}


def test_csv_round_trip(frame, tmp_path):
    df = frame("ts timestamp_ntz, v double, s string", [(T[1], 1.5, "a,b"), (T[0], None, 'q"q')])
    write_csv(df, str(tmp_path / "t"), ["ts"])
    assert sorted(map(str, read_csv_like(df, str(tmp_path / "t")).collect())) == sorted(map(str, df.collect()))
