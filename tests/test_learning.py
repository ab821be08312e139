"""Splits, folds, scaling, metrics, forecasters, search."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.errors import GuardError
from tempora.models import frames
from tempora.models.frames import check_fit_input, fit_rows, importance_table, load_model, predict, save_model
from tempora.models.linear import fit_linear, fit_ridge
from tempora.models import rounds, search
from tempora.models.rounds import Boosting, errors_by_round, fold_errors, thresholds
from tempora.models.search import draw_candidates, tune_boosted
from tempora.models.trees import boosting_estimator, fit_boosted, fit_boosted_default, fit_random_forest
from tempora.operators import metrics
from tempora.operators.scaling import fit_scaler, scale_with
from tempora.operators.split import chronological_split, expanding_folds, fold_blocks, split_part
from tempora.schemas import SEARCH_SPACE

START = dt.datetime(2024, 1, 1)


def timeline(spark, n, keys=("a",)):
    rows = [(k, START + dt.timedelta(minutes=30 * i), float(i)) for k in keys for i in range(n)]
    return spark.createDataFrame(rows[::-1], "k string, ts timestamp_ntz, y double")


@pytest.mark.parametrize("n", [7, 90, 333])
def test_split_sizes_truncate_binary_floats(spark, n):
    train = int(n * 0.70)
    sizes = {"train": train, "validation": int(n * 0.15), "test": n - train - int(n * 0.15)}
    out = chronological_split(timeline(spark, n), ts="ts")
    got = {r["split"]: r for r in out.groupBy("split").agg(F.count("*").alias("n"), F.min("y").alias("a"), F.max("y").alias("b")).collect()}
    assert {k: r["n"] for k, r in got.items()} == sizes
    assert got["train"]["b"] + 1 == got["validation"]["a"] and got["validation"]["b"] + 1 == got["test"]["a"]


def test_split_per_series(spark):
    df = timeline(spark, 100, ("a", "b")).union(timeline(spark, 40, ("c",)))
    out = chronological_split(df, ts="ts", series=("k",))
    got = {(r["k"], r["split"]): r["count"] for r in out.groupBy("k", "split").count().collect()}
    assert got[("a", "train")] == 70 and got[("c", "train")] == 28 and got[("c", "validation")] == 6
    assert split_part(out, "train", "validation").count() == 70 * 2 + 15 * 2 + 34


def test_split_guards(spark):
    df = timeline(spark, 10)
    for ratios in [(0, 0.1), (1, 0.1), (0.5, 0), (0.75, 0.25), (0.9, 0.2)]:
        with pytest.raises(GuardError):
            chronological_split(df, *ratios, ts="ts")
    with pytest.raises(GuardError, match="repeated"):
        chronological_split(df.union(df), ts="ts", check=True)
    with pytest.raises(GuardError, match="only"):
        chronological_split(timeline(spark, 2), ts="ts", check=True)
    with pytest.raises(GuardError, match="absent"):
        chronological_split(df, ts="nope")


@pytest.mark.parametrize("n, k", [(103, 4), (30, 2)])
def test_fold_boundaries(spark, n, k):
    size = n // (k + 1)
    out = expanding_folds(timeline(spark, n), k, ts="ts")
    got = {(r["fold"], r["role"]): (r["a"], r["b"]) for r in out.groupBy("fold", "role").agg(F.min("y").alias("a"), F.max("y").alias("b")).collect()}
    for i in range(k):
        start = n - (k - i) * size
        assert got[(i, "train")] == (0, start - 1)
        assert got[(i, "test")] == (start, start + size - 1)
    with pytest.raises(GuardError):
        expanding_folds(timeline(spark, n), 1, ts="ts")


def test_scaling_uses_population_deviation_and_training_rows(frame):
    train = frame("x double, c double", [(1.0, 5.0), (3.0, 5.0)])
    full = frame("x double, c double", [(1.0, 5.0), (3.0, 5.0), (7.0, 6.0)])
    want = [(-1.0, 0.0), (1.0, 0.0), (5.0, 1.0)]
    assert [tuple(r) for r in scale_with(full, train, ["x", "c"]).orderBy("x").collect()] == want
    assert [tuple(r) for r in fit_scaler(train, ["x", "c"]).transform(full).orderBy("x").collect()] == want
    assert "s_x" in fit_scaler(train, ["x"]).transform(full, "s_").columns
    with pytest.raises(GuardError):
        fit_scaler(train.limit(0), ["x"])


def test_metrics(frame):
    rng = np.random.default_rng(0)
    y, p = rng.uniform(1, 9, 50), rng.uniform(1, 9, 50)
    df = frame("actual double, predicted double", [(float(a), float(b)) for a, b in zip(y, p)])
    got = metrics.regression_metrics(df).first()
    assert got["MAE"] == pytest.approx(np.abs(y - p).mean())
    assert got["RMSE"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got["MAPE"] == pytest.approx(np.abs((y - p) / y).mean() * 100)
    assert got["R2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


@pytest.mark.parametrize("rows, r2", [([(2.0, 2.0), (2.0, 2.0)], 1.0), ([(2.0, 1.0), (2.0, 3.0)], 0.0)])
def test_r2_of_a_constant_target(frame, rows, r2):
    assert metrics.regression_metrics(frame("actual double, predicted double", rows)).first()["R2"] == r2


def test_metric_guards(frame):
    df = frame("actual double, predicted double", [(0.0, 1.0)])
    with pytest.raises(Exception, match="MAPE is undefined"):
        metrics.regression_metrics(df).collect()
    for odd in ([], [(1.0, None)], [(None, 1.0)], [(1.0, float("nan"))], [(1.0, 1.0), (2.0, 2.0), (10.0, None)]):
        rows = frame("actual double, predicted double", odd)
        for compute in (metrics.regression_metrics, metrics.evaluate_models):
            with pytest.raises(Exception, match="there are no rows" if not odd else "is missing"):
                compute(rows).collect()
    with pytest.raises(GuardError):
        metrics.evaluate_models(df.select("actual"))
    with pytest.raises(GuardError):
        metrics.evaluate_models(df, "nope")


def test_leaderboard_and_selection(frame):
    df = frame("actual double, good double, bad double, worse double", [(1.0, 1.0, 2.0, 4.0), (2.0, 2.5, 3.0, 9.0)])
    board = metrics.evaluate_models(df)
    assert [r["model"] for r in board.collect()] == ["good", "bad", "worse"]
    assert metrics.select_best(board, ["bad", "worse"]).first()["model"] == "bad"
    gain = {r["model"]: r["MAE_improvement"] for r in metrics.metric_improvement(board, "bad").collect()}
    assert gain["bad"] == 0 and gain["good"] == 0.75


def test_baselines(frame):
    df = frame("OPERATIONAL_DEMAND double, lag_1 double, lag_48 double, lag_336 double", [(1.0, 2.0, 3.0, None)])
    assert metrics.baseline_predictions(df).columns == ["actual", "previous_interval", "previous_day", "previous_week"]
    with pytest.raises(GuardError, match="lag_336"):
        metrics.baseline_predictions(df, check=True)


def test_cv_summary(frame):
    rows = [(0, 1.0, 1.0, 2.0), (0, 3.0, 1.0, 4.0), (1, 2.0, 0.0, 1.0), (1, 2.0, 2.0, 1.0), (2, 9.0, 0.0, 0.0)]
    df = frame("candidate int, validation_MAE double, training_MAE double, fit_time double", rows)
    got = {r["candidate"]: r for r in metrics.cv_summary(df).collect()}
    assert got[0]["std_validation_MAE"] == 1.0 and got[0]["mean_fit_time"] == 3.0
    assert [got[i]["rank_test_score"] for i in range(3)] == [1, 1, 3]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    y = 3 + x @ [2.0, -1.0, 0.5] + rng.normal(scale=0.1, size=120)
    rows = [(START + dt.timedelta(minutes=30 * i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "ts timestamp_ntz, a double, b double, c double, y double").cache(), x, y


def predictions(model, df):
    return np.array([r["predicted"] for r in predict(model, df, ["ts"], "y").orderBy("ts").collect()])


def test_least_squares_and_ridge(matrix):
    df, x, y = matrix
    a = np.column_stack([np.ones(len(y)), x])
    want = a @ np.linalg.lstsq(a, y, rcond=None)[0]
    np.testing.assert_allclose(predictions(fit_linear(df, ["a", "b", "c"], "y"), df), want, atol=1e-9)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(3), xc.T @ yc)
    np.testing.assert_allclose(predictions(fit_ridge(df, ["a", "b", "c"], "y", 7.0), df), y.mean() + xc @ w, atol=1e-9)
    with pytest.raises(GuardError):
        fit_ridge(df, ["a"], "y", -1)


def test_collinear_features_are_accepted(matrix):
    df, x, y = matrix
    twin = df.withColumn("a2", F.col("a") * 2)
    want = predictions(fit_linear(df, ["a", "b"], "y"), df)
    np.testing.assert_allclose(predictions(fit_linear(twin, ["a", "b", "a2"], "y"), twin), want, atol=1e-6)


def test_forests_and_boosting(matrix, tmp_path):
    df, x, y = matrix
    names = ["a", "b", "c"]
    forest = fit_random_forest(df, names, "y", n_estimators=5, max_depth=4, max_bins=32)
    assert np.abs(predictions(forest, df) - y).mean() < np.abs(y - y.mean()).mean()
    boosted = fit_boosted_default(df, names, "y", n_estimators=4, max_depth=3)
    assert np.abs(predictions(boosted, df) - y).mean() < np.abs(y - y.mean()).mean()
    table = importance_table(forest, df).collect()
    assert table[0]["feature"] == "a" and sum(r["importance"] for r in table) == pytest.approx(1)
    save_model(boosted, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    assert again.stages[0].getInputCols() == names
    np.testing.assert_allclose(predictions(again, df), predictions(boosted, df))


@pytest.mark.parametrize(
    "args",
    [{"n_estimators": 0}, {"learning_rate": 0}, {"max_depth": 0}, {"min_child_weight": -1}, {"subsample": 0}, {"subsample": 1.1}, {"colsample_bytree": 0}],
)
def test_boosting_arguments(matrix, args):
    with pytest.raises(GuardError):
        fit_boosted(matrix[0], ["a"], "y", **args)


@pytest.mark.parametrize("args", [{"n_estimators": 0}, {"max_depth": 0}, {"min_samples_leaf": 0}])
def test_forest_arguments(matrix, args):
    with pytest.raises(GuardError):
        fit_random_forest(matrix[0], ["a"], "y", **args)


def test_boosting_parameter_mapping(spark):
    e = boosting_estimator({"n_estimators": 7, "learning_rate": 0.2, "max_depth": 3, "min_child_weight": 5, "subsample": 0.8, "colsample_bytree": 0.9})
    assert (e.getMaxIter(), e.getStepSize(), e.getMaxDepth(), e.getMinInstancesPerNode()) == (7, 0.2, 3, 5)
    assert (e.getSubsamplingRate(), e.getFeatureSubsetStrategy()) == (0.8, "0.9")


def test_fit_guards(matrix, frame):
    df = matrix[0]
    gaps = frame("a double, y double", [(None, 1.0)])
    for train, features in [(gaps, ["a"]), (df.limit(0), ["a"]), (df, []), (df, ["zz"]), (frame("a string, y double", [("x", 1.0)]), ["a"])]:
        with pytest.raises(GuardError):
            check_fit_input(train, features, "y")
    with pytest.raises(GuardError, match="validation"):
        check_fit_input(df, ["a"], "y", df.select("b"))
    with pytest.raises(GuardError, match="y"):
        check_fit_input(frame("a double, y double", [(1.0, float("nan"))]), ["a"], "y")


def test_candidates_are_distinct_and_reproducible():
    got = draw_candidates(SEARCH_SPACE, 25, 42)
    assert got == draw_candidates(SEARCH_SPACE, 25, 42) != draw_candidates(SEARCH_SPACE, 25, 43)
    assert len({json.dumps(g) for g in got}) == 25
    assert all(g[k] in v for g in got for k, v in SEARCH_SPACE.items())
    assert len(draw_candidates({"a": [1, 2], "b": [1]}, 9)) == 2


def test_search(matrix):
    df = matrix[0]
    space = {"n_estimators": [2], "max_depth": [1, 3], "learning_rate": [0.3]}
    found = tune_boosted(df, ["a", "b", "c"], "y", "ts", n_iter=2, n_splits=2, space=space, max_bins=32)
    rows = found.results.collect()
    assert [r["rank_test_score"] for r in rows] == [1, 2]
    assert found.best_score == rows[0]["mean_validation_MAE"] <= rows[1]["mean_validation_MAE"]
    assert found.best_parameters == json.loads(rows[0]["params"])
    for bad in ({"n_iter": 0}, {"n_splits": 1}):
        with pytest.raises(GuardError):
            tune_boosted(df, ["a"], "y", "ts", **bad)


def test_candidates_that_differ_in_rounds_share_a_fit(spark, monkeypatch):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=i), float(i % 7), rnd.random(), 3.0 * (i % 7) + rnd.random()) for i in range(120)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, a double, b double, y double")
    fits = []
    plain = search.boosting_estimator
    monkeypatch.setattr(search, "boosting_estimator", lambda p, *rest: fits.append(dict(p)) or plain(p, *rest))
    space = {"n_estimators": [2, 5, 9], "learning_rate": [0.2], "max_depth": [2], "subsample": [1.0]}
    found = tune_boosted(df, ["a", "b"], "y", "ts", n_iter=3, n_splits=2, space=space, max_bins=16)
    assert [f["n_estimators"] for f in fits[:2]] == [9, 9] and len(fits) == 3  # two folds, one refit
    # Each score is what a fit of just these rounds gives.
    blocks = fold_blocks(df, 2, "ts").cache()
    for r in found.results.collect():
        p, maes = json.loads(r["params"]), []
        for f in range(2):
            train = blocks.filter(F.col("block") <= f).drop("block")
            model = fit_boosted_default(train, ["a", "b"], "y", max_bins=16, check=False, **p)
            error = F.avg(F.abs(F.col("actual") - F.col("predicted")))
            maes.append(predict(model, blocks.filter(F.col("block") == f + 1), ["ts"], "y").agg(error).first()[0])
        assert r["mean_validation_MAE"] == pytest.approx(sum(maes) / 2)


def test_fold_blocks_hold_each_row_once(spark):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for k, n in (("a", 23), ("b", 11), ("short", 3)) for i in range(n)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz").cache()
    blocks = fold_blocks(df, 4, "ts", ("k",)).cache()
    assert blocks.count() == 34
    for f in range(4):
        want = {(r["k"], r["ts"]): r["role"] for r in expanding_folds(df, 4, "ts", ("k",)).filter(F.col("fold") == f).collect()}
        got = {(r["k"], r["ts"]): "train" if r["block"] <= f else "test" for r in blocks.filter(F.col("block") <= f + 1).collect()}
        assert got == want


def test_rows_of_a_fit_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(frames, "FIT_ROWS", 100)
    dealt = fit_rows(spark.range(450).coalesce(1))  # stored in one file
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) <= 100 and sum(sizes) == 450
    assert fit_rows(spark.range(100).repartition(3)).rdd.getNumPartitions() == 1


@pytest.fixture(scope="module")
def folded(spark):
    """150 rows to train on and 50 to test on: a few levels, a constant, 150 distinct values where there are 32 bins."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 7, 200), np.full(200, 2.0), rng.normal(size=(200, 2))])
    y = 3 * x[:, 0] + np.sin(2 * x[:, 2]) + rng.normal(scale=0.3, size=200)
    rows = [(*map(float, r), float(v), i % 4 == 3) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double, is_test boolean")
    vectors = frames.assembler(["a", "b", "c", "d"]).transform(df).select("features", "y", "is_test").cache()
    return vectors, x, y, np.arange(200) % 4 == 3


@pytest.mark.parametrize("few", [0, 2000])
def test_a_fit_in_one_task_equals_sparks(folded, monkeypatch, few):
    df, x, y, is_test = folded
    e = boosting_estimator({"n_estimators": 6, "learning_rate": 0.1, "max_depth": 3, "min_child_weight": 5}, max_bins=32)
    model = e.setFeaturesCol("features").setLabelCol("y").fit(df.filter("not is_test").coalesce(1))
    monkeypatch.setattr(rounds, "FEW_ROWS", few)
    tested, trained = errors_by_round(x, y, is_test, Boosting.of(e))
    for part, got in ((df.filter("is_test"), tested), (df.filter("not is_test"), trained)):
        np.testing.assert_allclose(got, model.evaluateEachIteration(part, "absolute"), rtol=1e-9)
    first, second, took = fold_errors(df.repartition(3), "features", "y", "is_test", e)
    np.testing.assert_allclose([first, second], [tested, trained], rtol=1e-12)
    assert took > 0


def test_sampled_rounds_learn_and_are_reproducible(folded):
    _, x, y, is_test = folded
    p = Boosting(40, 0.1, 4, 2, 0.7, 0.5, 32, 42)
    tested, trained = errors_by_round(x, y, is_test, p)
    back = np.arange(200)[::-1]  # stored in another order
    again = errors_by_round(x[back], y[back], is_test[back], p)
    np.testing.assert_allclose([tested, trained], again)
    whole = errors_by_round(x, y, is_test, Boosting(40, 0.1, 4, 2, 1.0, 1.0, 32, 42))
    assert trained[-1] < trained[0] and tested[-1] < np.abs(y - y.mean()).mean() and not np.allclose(trained, whole[1])


def test_deep_trees_keep_their_least_rows(folded):
    _, x, y, is_test = folded
    # With one row a leaf, one tree learns every training row by heart; a leaf of 75 rows or more allows one split at most.
    by_heart = errors_by_round(x, y, is_test, Boosting(1, 0.1, 30, 1, 1.0, 1.0, 256, 1))[1]
    assert by_heart[0] == pytest.approx(0, abs=1e-12)
    alone = errors_by_round(x, y, is_test, Boosting(1, 0.1, 30, 76, 1.0, 1.0, 256, 1))[1]
    train = y[~is_test]
    assert alone[0] == pytest.approx(np.abs(train - train.mean()).mean())


def test_thresholds_are_midpoints_or_even_counts():
    assert thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert thresholds(np.full(5, 7.0), 32).tolist() == []
    assert thresholds(np.arange(8.0), 4).tolist() == [1.5, 3.5, 5.5]


def test_rows_beyond_one_task_are_fitted_by_spark(matrix, monkeypatch):
    df = matrix[0]
    space = {"n_estimators": [2], "max_depth": [2], "learning_rate": [0.3]}
    options = {"n_iter": 1, "n_splits": 2, "space": space, "max_bins": 32}
    within = tune_boosted(df, ["a", "b", "c"], "y", "ts", **options).best_score
    monkeypatch.setattr(search, "TASK_CELLS", 3 * 80)  # the first fold has 80 rows, the second 120
    asked = []
    plain = search.fold_errors
    monkeypatch.setattr(search, "fold_errors", lambda *args: asked.append(args) or plain(*args))
    assert tune_boosted(df, ["a", "b", "c"], "y", "ts", **options).best_score == pytest.approx(within)
    assert len(asked) == 1


def test_a_fold_without_rows_is_refused(folded):
    df = folded[0]
    for part in ("is_test", "not is_test", "false"):
        with pytest.raises(GuardError, match="no rows"):
            fold_errors(df.filter(part), "features", "y", "is_test", boosting_estimator({"n_estimators": 1}))
