"""From a training table to a chosen, tested forecaster with reports and outputs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tempora.models.frames import fit, importance_table, predict, save_model
from tempora.models.linear import fit_linear, fit_ridge
from tempora.models.search import SearchResult, tune_boosted
from tempora.models.trees import boosting_estimator, fit_boosted_default, fit_random_forest
from tempora.operators.columns import feature_columns, model_columns, with_residual
from tempora.operators.joins import attach_weather
from tempora.operators.metrics import baseline_predictions, evaluate_models, regression_metrics, select_best
from tempora.operators.scaling import FittedScaler, fit_scaler
from tempora.operators.split import chronological_split, split_part
from tempora.plans.demand import demand_features
from tempora.plans.training import prepare_training
from tempora.quality.reports import demand_report, enforce, merge_report, model_output_report, series_report
from tempora.quality.reports import split_report, training_report, weather_report
from tempora.schemas import BASELINES, SEED, SOURCE_FILE, TARGET, TRAIN_RATIO, TS, VALIDATION_RATIO, WEATHER_COLUMNS
from tempora.session import materialise, scratch_scope
from tempora.sinks.reports import plain, write_report
from tempora.sinks.runs import RunFolder
from tempora.sinks.tables import write_csv, write_merge_details, write_training_table
from tempora.sources.tagged import POSITION

BOOSTED = ["default_boosted", "tuned_boosted"]
SCALED = "scaled_"


@dataclass
class Budget:
    """Sizes of the model fits. The defaults are the full-size run."""

    forest_trees: int = 300
    forest_depth: int = 20
    boosted_default: dict = field(default_factory=dict)
    search_iterations: int = 25
    search_folds: int = 4
    search_parallelism: int = 4
    search_space: dict | None = None
    max_bins: int = 256


@dataclass
class Candidates:
    comparison: DataFrame
    predictions: DataFrame
    scaler: FittedScaler
    models: dict[str, PipelineModel]
    search: SearchResult


@dataclass
class Forecast:
    selected: str
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame


def split_table(
    df: DataFrame, ts: str = TS, series: tuple[str, ...] = (), train: float = TRAIN_RATIO, validation: float = VALIDATION_RATIO
) -> DataFrame:
    """Labelled rows. The table is checkpointed before the split reads it and after, for the fits."""
    return materialise(chronological_split(materialise(df), train, validation, ts, series, check=True))


def fit_candidates(
    labelled: DataFrame,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    budget: Budget | None = None,
    seed: int = SEED,
) -> Candidates:
    """Baselines, least squares, ridge, forest, default and tuned boosted trees, compared on validation."""
    b = budget or Budget()
    train, validation = split_part(labelled, "train"), split_part(labelled, "validation")
    features = feature_columns(train, ts, target, series)
    keys = [*series, ts]
    scaler = fit_scaler(train, features)
    scaled = [SCALED + c for c in features]
    with_scaled = scaler.transform(train, SCALED)
    search = tune_boosted(
        train, features, target, ts, series, b.search_iterations, b.search_folds, seed,
        b.search_parallelism, space=b.search_space, max_bins=b.max_bins,
    )
    models = {
        "linear_regression": fit_linear(with_scaled, scaled, target),
        "ridge_regression": fit_ridge(with_scaled, scaled, target, check=False),
        "random_forest": fit_random_forest(
            train, features, target, b.forest_trees, b.forest_depth, seed=seed, max_bins=b.max_bins
        ),
        "default_boosted": fit_boosted_default(train, features, target, seed, False, b.max_bins, **b.boosted_default),
        "tuned_boosted": search.model,
    }
    # Every model adds one column to the same rows; nothing is joined or matched by position.
    kept = tuple(dict.fromkeys([*keys, *features]))
    scored = scaler.transform(baseline_predictions(validation, target, keep=kept), SCALED)
    for name, model in models.items():
        scored = model.transform(scored).drop("features").withColumnRenamed("prediction", name)
    names = [*BASELINES, *models]
    predictions = materialise(scored.select(*keys, "actual", *names))
    comparison = evaluate_models(predictions.drop(*keys), "actual", names)
    return Candidates(comparison, predictions, scaler, models, search)


def final_forecast(
    labelled: DataFrame,
    selected: str,
    parameters: dict | None,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    seed: int = SEED,
    max_bins: int = 256,
) -> Forecast:
    """Refit on train + validation, predict the test part once."""
    train, test = split_part(labelled, "train", "validation"), split_part(labelled, "test")
    features = feature_columns(train, ts, target, series)
    model = fit(boosting_estimator(parameters or {}, seed, max_bins), train, features, target)
    predictions = with_residual(predict(model, test, [*series, ts], target))
    return Forecast(selected, model, predictions, regression_metrics(predictions))


def run_forecast(
    demand: DataFrame,
    weather: DataFrame,
    output: str,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    weather_keys: list[str] | None = None,
    weather_columns: list[str] | None = None,
    on_unmatched: str = "error",
    budget: Budget | None = None,
    seed: int = SEED,
) -> dict:
    """Reports, training table, candidates, selection, final test, outputs; stops at the first failing report.

    ``demand`` is cleaned demand, ``weather`` the half-hour weather with or without derived features.
    Both, and each later table that several steps read, are checkpointed once. All outputs go below
    ``output``.
    """
    spark = demand.sparkSession
    b = budget or Budget()
    checks, details = f"{output}/verification", f"{output}/verification/details"
    keys = weather_keys or [ts]
    columns = WEATHER_COLUMNS if weather_columns is None else weather_columns
    demand, weather = materialise(demand), materialise(weather)

    enforce(series_report(demand, ts, (*series, ts), series=series, details=details), f"{checks}/00_existing_demand_validation.json")
    ingested = (SOURCE_FILE, POSITION) if {SOURCE_FILE, POSITION} <= set(demand.columns) else None
    enforce(demand_report(demand, ts, target, series, ingested), f"{checks}/01_demand_validation.json")
    enforce(weather_report(weather, ts, tuple(k for k in keys if k != ts)), f"{checks}/02_weather_validation.json")
    features_only = demand_features(model_columns(demand, series, ts, target), ts, target, series)
    merged = materialise(attach_weather(features_only, weather, keys, columns, on_unmatched, demand_keys=[*series, ts]))
    write_merge_details(demand, weather, merged, details, keys, columns)
    enforce(merge_report(demand, weather, merged, keys, columns, demand_keys=[*series, ts]), f"{checks}/03_merge_validation.json")
    in_order = merged.select(*features_only.columns, *columns)
    table = materialise(prepare_training(in_order, ts, series))
    enforce(training_report(table, ts, target, series), f"{checks}/04_training_dataset_validation.json")

    labelled = materialise(chronological_split(table, ts=ts, series=series, check=True))
    features = feature_columns(table, ts, target, series)
    parts = {p: split_part(labelled, p) for p in ("train", "validation", "test")}
    split_found = enforce(
        split_report(table, *parts.values(), features, ts, target, series), f"{checks}/05_split_validation.json"
    )

    found = fit_candidates(labelled, ts, target, series, b, seed)
    comparison = materialise(found.comparison)
    selected = select_best(comparison, BOOSTED).first()["model"]
    parameters = found.search.best_parameters if selected == "tuned_boosted" else b.boosted_default or None
    result = final_forecast(labelled, selected, parameters, ts, target, series, seed, b.max_bins)
    predictions = materialise(result.predictions)
    metrics = regression_metrics(predictions)
    enforce(
        model_output_report(comparison, predictions, metrics, selected), f"{checks}/06_model_output_validation.json"
    )

    order = [*series, ts]
    write_csv(comparison, f"{output}/metrics/validation_model_comparison.csv", ["MAE", "model"])
    shown = found.predictions.select(*order, "actual", *BOOSTED)
    write_csv(shown, f"{output}/predictions/boosted_validation_predictions.csv", order)
    write_csv(found.search.results, f"{output}/tuning/boosted_cv_results.csv", ["rank_test_score", "params"])
    write_csv(predictions, f"{output}/predictions/final_test_predictions.csv", order)
    write_training_table(table, output, ts, series)
    write_csv(
        importance_table(result.model, table),
        f"{output}/feature_importance/final_boosted_feature_importance.csv", ["importance"],
    )
    write_csv(
        importance_table(found.models["random_forest"], table),
        f"{output}/feature_importance/random_forest_feature_importance.csv", ["importance"],
    )
    save_model(result.model, f"{output}/models/final_model")

    test_metrics = plain(metrics.first())
    write_report(spark, found.search.best_parameters, f"{output}/tuning/best_boosted_parameters.json")
    choice = {
        "selected_model": selected,
        "selected_parameters": found.search.best_parameters if selected == "tuned_boosted" else None,
        "best_cross_validation_MAE": found.search.best_score,
    }
    write_report(spark, choice, f"{output}/metrics/model_selection.json")
    write_report(spark, test_metrics, f"{output}/metrics/final_test_metrics.json")
    summary = {
        "status": "PASS",
        "dataset_rows": split_found["full_row_count"],
        "feature_count": len(features),
        "split_rows": {p: split_found[f"{p}_row_count"] for p in parts},
        "selected_model": selected,
        "best_tuning_cv_mae": found.search.best_score,
        # One row per model.
        "validation_models": [plain(r) for r in comparison.orderBy("MAE", "model").collect()],
        "final_test_metrics": test_metrics,
        "verification_directory": checks,
    }
    write_report(spark, summary, f"{checks}/07_pipeline_summary.json")
    return summary


def published_forecast(demand: DataFrame, weather: DataFrame, output: str, **options) -> dict:
    """``run_forecast`` as one unit: all outputs in a run folder of their own, published by a manifest at the end.

    Scratch tables go when the run has ended well. A failing report raises, leaves the reports saved so far in the run's folder and
    publishes nothing. Returns the manifest; its ``summary`` is that of the run.
    """
    run = RunFolder(demand.sparkSession, output)
    with scratch_scope(demand.sparkSession):
        return run.publish(run_forecast(demand, weather, run.root, **options))
