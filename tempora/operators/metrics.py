"""Forecast metrics, leaderboards and search summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tempora.errors import GuardError
from tempora.operators.columns import require_columns, require_no_missing
from tempora.schemas import BASELINES, TARGET


def metric_aggregates(actual: Column, predicted: Column) -> list[Column]:
    """MAE, RMSE, MAPE (percent) and R2 as plain aggregates, so Spark combines them map-side.

    Missing values, no rows at all, and a zero actual value (which leaves MAPE undefined) raise at run time, in the
    same aggregate. R2 of a constant target is 1 for a perfect forecast and 0 otherwise.
    """
    error = actual - predicted
    ratio = F.when(actual == 0, F.raise_error("MAPE is undefined: an actual value is zero").cast("double")).otherwise(
        F.abs(error / actual)
    )
    residual = F.sum(error * error)
    spread = F.var_pop(actual) * F.count(actual)
    missing = actual.isNull() | predicted.isNull() | F.isnan(actual) | F.isnan(predicted)

    def guarded(value: Column) -> Column:
        empty = F.raise_error("metrics: there are no rows").cast("double")
        incomplete = F.raise_error("metrics: an actual or predicted value is missing").cast("double")
        return F.when(F.count(F.lit(1)) == 0, empty).when(F.count_if(missing) > 0, incomplete).otherwise(value)

    named = {
        "MAE": F.avg(F.abs(error)),
        "RMSE": F.sqrt(F.avg(error * error)),
        "MAPE": F.avg(ratio) * 100,
        "R2": F.when(spread > 0, 1 - residual / spread).when(residual == 0, 1.0).otherwise(0.0),
    }
    return [guarded(value).alias(name) for name, value in named.items()]


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row of metrics; an empty input raises."""
    require_columns(df, [actual, predicted], "metrics")
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.agg(*metric_aggregates(a, p))


def evaluate_models(df: DataFrame, actual: str = "actual", models: list[str] | None = None) -> DataFrame:
    """Metrics per prediction column, best MAE first.

    All models are aggregated side by side in one pass; rows are not multiplied per model.
    """
    require_columns(df, [actual], "evaluation")
    models = models if models is not None else [c for c in df.columns if c != actual]
    if not models:
        raise GuardError("evaluation: no prediction columns")
    require_columns(df, models, "evaluation")
    a = F.col(actual).cast("double")
    side_by_side = df.agg(
        *[F.struct(F.lit(m).alias("model"), *metric_aggregates(a, F.col(m).cast("double"))).alias(f"m{i}") for i, m in enumerate(models)]
    )
    long = side_by_side.select(F.inline(F.array(*[f"m{i}" for i in range(len(models))])))
    return leaderboard(long)


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.asc("MAE"), F.asc("model"))


def baseline_predictions(df: DataFrame, target: str = TARGET, keep: tuple[str, ...] = (), check: bool = False) -> DataFrame:
    """Naive forecasts: the value one interval, one day and one week earlier."""
    columns = {"actual": target, **BASELINES}
    require_columns(df, [target, *BASELINES.values(), *keep], "baselines")
    if check:
        require_no_missing(df, list(columns.values()), "baselines")
    return df.select(*keep, *[F.col(source).alias(name) for name, source in columns.items()])


def select_best(comparison: DataFrame, among: list[str]) -> DataFrame:
    """The candidate with the lowest MAE among the named ones."""
    key = F.struct("MAE", "model")
    return comparison.filter(F.col("model").isin(among)).agg(
        F.min_by("model", key).alias("model"), F.min("MAE").alias("MAE")
    )


def metric_improvement(comparison: DataFrame, default: str, metric: str = "MAE") -> DataFrame:
    """Reduction of the metric against the default model; the default is a scalar subquery."""
    base = comparison.filter(F.col("model") == default).agg(F.min(metric)).scalar()
    return comparison.withColumn(f"{metric}_improvement", base - F.col(metric))


def cv_summary(scores: DataFrame, candidate: str = "candidate") -> DataFrame:
    """Per candidate: mean and population deviation of the fold scores, mean train score and fit time, rank.

    The ranking window runs over one row per candidate.
    """
    require_columns(scores, [candidate, "validation_MAE", "training_MAE", "fit_time"], "cv summary")
    per = scores.groupBy(candidate).agg(
        F.avg("validation_MAE").alias("mean_validation_MAE"),
        F.stddev_pop("validation_MAE").alias("std_validation_MAE"),
        F.avg("training_MAE").alias("mean_training_MAE"),
        F.avg("fit_time").alias("mean_fit_time"),
    )
    rank = F.rank().over(Window.partitionBy(F.lit(0)).orderBy("mean_validation_MAE"))
    return per.withColumn("rank_test_score", rank)
