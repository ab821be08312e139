"""Random forest and boosted trees."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame

from tempora.errors import GuardError
from tempora.models.frames import check_fit_input, fit
from tempora.schemas import SEED

# Spark's tree depth limit.
DEEPEST = 30
MAX_BINS = 256


def fit_random_forest(
    train: DataFrame,
    features: list[str],
    target: str,
    n_estimators: int = 300,
    max_depth: int | None = 20,
    min_samples_leaf: int = 2,
    max_features: str | float = "all",
    seed: int = SEED,
    max_bins: int = MAX_BINS,
    check: bool = True,
) -> PipelineModel:
    """``max_depth=None`` is the deepest that Spark grows, 30 levels."""
    if n_estimators < 1:
        raise GuardError("random forest: n_estimators must be positive")
    if max_depth is not None and not 1 <= max_depth <= DEEPEST:
        raise GuardError(f"random forest: max_depth must lie in 1 to {DEEPEST}")
    if min_samples_leaf < 1:
        raise GuardError("random forest: min_samples_leaf must be positive")
    if check:
        check_fit_input(train, features, target)
    subset = "all" if max_features in (1.0, "all") else str(max_features)
    estimator = RandomForestRegressor(
        numTrees=n_estimators,
        maxDepth=DEEPEST if max_depth is None else max_depth,
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy=subset,
        maxBins=max_bins,
        seed=seed,
    )
    return fit(estimator, train, features, target)


def _check_boosting(p: dict) -> None:
    for name in ("n_estimators", "learning_rate", "max_depth"):
        if p[name] <= 0:
            raise GuardError(f"boosted trees: {name} must be positive")
    if p["max_depth"] > DEEPEST:
        raise GuardError(f"boosted trees: max_depth must not exceed {DEEPEST}")
    if p["min_child_weight"] < 0:
        raise GuardError("boosted trees: min_child_weight must not be negative")
    for name in ("subsample", "colsample_bytree"):
        if not 0 < p[name] <= 1:
            raise GuardError(f"boosted trees: {name} must lie in (0, 1]")


DEFAULT_ROUNDS = 100


def boosting_estimator(params: dict, seed: int = SEED, max_bins: int = MAX_BINS) -> GBTRegressor:
    """Library-neutral parameter names to Spark's; a name without a counterpart (L1, L2, gamma) raises."""
    known = {
        "n_estimators": DEFAULT_ROUNDS,
        "learning_rate": 0.3,
        "max_depth": 6,
        "min_child_weight": 1,
        "subsample": 1.0,
        "colsample_bytree": 1.0,
    }
    if unknown := sorted(set(params) - set(known)):
        raise GuardError(f"boosted trees: no such parameters: {unknown}")
    p = {**known, **params}
    _check_boosting(p)
    share = p["colsample_bytree"]
    return GBTRegressor(
        maxIter=int(p["n_estimators"]),
        stepSize=float(p["learning_rate"]),
        maxDepth=int(p["max_depth"]),
        minInstancesPerNode=max(1, round(p["min_child_weight"])),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy="all" if share == 1.0 else str(share),
        maxBins=max_bins,
        seed=seed,
    )


def fit_boosted_default(
    train: DataFrame, features: list[str], target: str, seed: int = SEED, check: bool = True, max_bins: int = MAX_BINS, **overrides
) -> PipelineModel:
    """100 rounds, rate 0.3, depth 6 unless overridden."""
    if check:
        check_fit_input(train, features, target)
    return fit(boosting_estimator(overrides, seed, max_bins), train, features, target)


def fit_boosted(
    train: DataFrame,
    features: list[str],
    target: str,
    n_estimators: int = 500,
    learning_rate: float = 0.05,
    max_depth: int = 6,
    min_child_weight: float = 1.0,
    subsample: float = 0.9,
    colsample_bytree: float = 0.9,
    seed: int = SEED,
    max_bins: int = MAX_BINS,
    check: bool = True,
) -> PipelineModel:
    params = {
        "n_estimators": n_estimators,
        "learning_rate": learning_rate,
        "max_depth": max_depth,
        "min_child_weight": min_child_weight,
        "subsample": subsample,
        "colsample_bytree": colsample_bytree,
    }
    estimator = boosting_estimator(params, seed, max_bins)
    if check:
        check_fit_input(train, features, target)
    return fit(estimator, train, features, target)
