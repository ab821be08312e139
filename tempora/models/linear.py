"""Least squares and ridge on standardised features."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from tempora.errors import GuardError
from tempora.models.frames import check_fit_input, fit


def fit_linear(train: DataFrame, features: list[str], target: str, check: bool = True) -> PipelineModel:
    """Ordinary least squares through the normal equations: one distributed pass."""
    if check:
        check_fit_input(train, features, target)
    return fit(LinearRegression(solver="normal", standardization=False), train, features, target)


def fit_ridge(
    train: DataFrame, features: list[str], target: str, alpha: float = 1.0, check: bool = True
) -> PipelineModel:
    """Penalty ``alpha * |w|^2`` on the sum of squared errors, intercept free.

    Spark minimises the mean squared error over the label's deviation, so the same penalty is
    ``alpha / n`` times that deviation.
    """
    if alpha < 0:
        raise GuardError("ridge: alpha must not be negative")
    if check:
        check_fit_input(train, features, target)
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col(target).cast("double")).alias("s")).first()
    strength = alpha / stats["n"] * (stats["s"] or 1.0)
    estimator = LinearRegression(solver="normal", standardization=False, regParam=strength, elasticNetParam=0.0)
    return fit(estimator, train, features, target)
