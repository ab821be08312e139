"""The whole run on a generated series, and the registered queries' contract."""

import datetime as dt
import inspect
import json
import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tempora.plans.demand import clean_demand
from tempora.errors import DataQualityError, GuardError
from tempora.plans.forecast import Budget, published_forecast, run_forecast
from tempora.plans.training import training_table
from tempora.plans.weather import clean_weather, weather_features
from tempora.schemas import DERIVED_WEATHER_COLUMNS, HOURLY_VARIABLES, TARGET, TS, WEATHER_COLUMNS
from tempora.session import materialise, scratch_path, scratch_scope
from tempora.sinks.runs import RunFolder, path_exists, published

START = dt.datetime(2025, 6, 1)
DAYS = 16


@pytest.fixture(scope="module")
def inputs(spark):
    rnd = random.Random(4)
    stamps = [START + dt.timedelta(minutes=30 * i) for i in range(48 * DAYS)]
    rows = []
    for t in stamps:
        level = 5000 + 800 * math.sin(t.hour / 24 * 2 * math.pi) + rnd.gauss(0, 40)
        text = t.strftime("%Y/%m/%d %H:%M:%S")
        rows.append(("A", text, str(round(level)), "0", "0", text, "f"))
        rows.append(("B", text, "1", "0", "0", text, "f"))
    schema = "REGIONID string, INTERVAL_DATETIME string, OPERATIONAL_DEMAND string, OPERATIONAL_DEMAND_ADJUSTMENT string, WDR_ESTIMATE string, LASTCHANGED string, SOURCE_FILE string"
    demand = clean_demand(spark.createDataFrame(rows, schema), "A")
    hours = [(START + dt.timedelta(hours=i)).isoformat() for i in range(24 * DAYS + 1)]
    raw = spark.createDataFrame(
        [(h, *[rnd.uniform(1, 30) for _ in HOURLY_VARIABLES]) for h in hours],
        "time string, " + ", ".join(f"{v} double" for v in HOURLY_VARIABLES),
    )
    return demand, weather_features(clean_weather(raw))


def test_training_table(inputs):
    demand, weather = inputs
    table = training_table(demand, weather, on_unmatched="error", check=True)
    assert len(table.columns) == 36 and table.columns[:2] == [TS, TARGET] and table.columns[-8:] == WEATHER_COLUMNS
    assert table.columns[2:13] == [
        "year", "month", "day", "day_of_week", "hour", "minute", "is_weekend", "lag_1", "lag_2", "lag_48", "lag_336",
    ]
    assert table.count() == 48 * DAYS - 336
    wide = training_table(demand, weather, weather_columns=WEATHER_COLUMNS + DERIVED_WEATHER_COLUMNS)
    assert len(wide.columns) == 36 + 13


def test_full_run(spark, inputs, tmp_path):
    demand, weather = inputs
    space = {"n_estimators": [2, 3], "learning_rate": [0.1, 0.3], "max_depth": [3]}
    small = Budget(4, 4, {"n_estimators": 3, "max_depth": 3}, 2, 2, 4, space, 32)
    out = str(tmp_path / "out")
    summary = run_forecast(demand, weather, out, budget=small)
    n = 48 * DAYS - 336
    train, validation = int(n * 0.7), int(n * 0.15)
    assert summary["split_rows"] == {"train": train, "validation": validation, "test": n - train - validation}
    assert summary["selected_model"] in ("default_boosted", "tuned_boosted") and summary["feature_count"] == 34
    assert [m["model"] for m in summary["validation_models"]] == [
        m["model"] for m in sorted(summary["validation_models"], key=lambda m: m["MAE"])
    ]
    assert len(summary["validation_models"]) == 8
    best = {m["model"]: m["MAE"] for m in summary["validation_models"]}
    assert best["linear_regression"] < best["previous_week"]

    def report(name):
        return json.loads("\n".join(r[0] for r in spark.read.text(f"{out}/{name}").collect()))

    for i, stage in enumerate(["existing_demand", "demand", "weather", "merge", "training_dataset", "split", "model_output"]):
        assert report(f"verification/0{i}_{stage}_validation.json").get("status", "PASS") == "PASS"
    assert report("verification/07_pipeline_summary.json")["selected_model"] == summary["selected_model"]
    assert report("verification/02_weather_validation.json")["missing_value_count"] == 8
    assert report("metrics/final_test_metrics.json").keys() == {"MAE", "RMSE", "MAPE", "R2"}
    read = spark.read.option("header", True)
    assert read.csv(f"{out}/predictions/final_test_predictions.csv").count() == n - train - validation
    assert read.csv(f"{out}/feature_importance/random_forest_feature_importance.csv").count() == 34
    assert spark.read.parquet(f"{out}/training_dataset.parquet").count() == n


def test_entry_and_registry(spark):
    got = entry_module.entry(spark)
    assert got.count() > 0 and len(got.columns) == 36
    names, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(names)
    # The training-data queries may be there or not; every other query has its SQL.
    assert {n for n in names if n not in sql} <= {n for n in names if n == "pipeline" or n.startswith("op") and n[2:3].isdigit()}


def test_registered_query_on_the_smallest_tables(spark):
    board = entry_module.queries()["evaluate_models"](spark, "/root/testdata/sf0.001")
    assert {r["model"] for r in board.collect()} == {"previous_interval", "previous_day", "previous_week"}
    assert board.filter(F.col("MAE") < 0).isEmpty()


def test_the_registered_custom_boosting_has_the_operators_size(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    from tempora import queries
    from tempora.models import trees

    fitted = []
    monkeypatch.setattr(queries, "_labelled", lambda *_: None)
    monkeypatch.setattr(queries, "_train_features", lambda _: (None, ["x"]))
    monkeypatch.setattr(trees, "check_fit_input", lambda *_: None)
    monkeypatch.setattr(trees, "fit", lambda estimator, *_: fitted.append(estimator))
    for name in ("predict", "split_part", "_stated"):
        monkeypatch.setattr(queries, name, lambda *_: None)
    queries.gbt_custom(None, "")
    (e,) = fitted
    assert isinstance(e, GBTRegressor) and (e.getMaxIter(), e.getStepSize(), e.getMaxDepth()) == (500, 0.05, 6)


def test_the_registered_comparison_searches_the_whole_space(spark, monkeypatch):
    from tempora import queries
    from tempora.models.search import draw_candidates, tune_boosted
    from tempora.plans import forecast
    from tempora.schemas import SEARCH_SPACE, SEED

    class Asked(Exception):
        pass

    def search(*args, **options):
        bound = inspect.signature(tune_boosted).bind(*args, **options)
        bound.apply_defaults()
        raise Asked(bound.arguments)

    rows = [(START + dt.timedelta(minutes=30 * i), float(i), float(i % 5), "train" if i < 6 else "validation") for i in range(8)]
    labelled = spark.createDataFrame(rows, f"{TS} timestamp_ntz, {TARGET} double, lag_1 double, split string")
    monkeypatch.setattr(queries, "_labelled", lambda *_: labelled)
    monkeypatch.setattr(forecast, "tune_boosted", search)
    with pytest.raises(Asked) as asked:
        queries.model_comparison(spark, "")
    (a,) = asked.value.args
    assert a["n_splits"] == 4 and a["max_bins"] == 256
    drawn = draw_candidates(a["space"] or SEARCH_SPACE, a["n_iter"], a["seed"])
    assert drawn == draw_candidates(SEARCH_SPACE, 25, SEED) and len(drawn) == 25


def test_a_refused_run_publishes_nothing(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * (i // 2)), 1.0) for i in range(40)]
    demand = spark.createDataFrame(rows, "INTERVAL_DATETIME timestamp_ntz, OPERATIONAL_DEMAND double")
    with pytest.raises(DataQualityError):
        published_forecast(demand, demand.limit(0), str(tmp_path))
    (folder,) = (tmp_path / "runs").iterdir()
    saved = spark.read.text(str(folder / "verification/01_demand_validation.json"), wholetext=True).first()[0]
    assert json.loads(saved)["failures"] == ["Some timestamps occur more than once."]
    assert not (tmp_path / "manifest.json").exists()
    with pytest.raises(GuardError, match="no published run"):
        published(spark, str(tmp_path))


def test_publishing_names_one_run_at_a_time(spark, tmp_path):
    first, second = RunFolder(spark, str(tmp_path)), RunFolder(spark, f"{tmp_path}/")
    first.publish({"status": "PASS"})
    assert published(spark, str(tmp_path))["run"] == first.id
    second.publish({"status": "PASS", "at": dt.datetime(2024, 1, 1)})
    found = published(spark, str(tmp_path))
    assert found["run"] == second.id and found["folder"] == second.root and found["summary"]["at"] == "2024-01-01T00:00:00"


def test_scratch_goes_when_the_block_ends_well(spark):
    with scratch_scope(spark) as folder:
        kept = materialise(spark.range(5)).agg({"id": "sum"}).first()[0]
        assert kept == 10 and path_exists(spark, folder)
    assert not path_exists(spark, folder)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark) as folder:
        materialise(spark.range(5))
        1 / 0
    assert path_exists(spark, folder)
    assert "scope-" not in scratch_path(spark, "later")
