"""Input checks, feature vectors, predictions and importance tables shared by all forecasters."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from tempora.errors import GuardError
from tempora.operators.columns import is_missing, non_numeric_columns, require_columns
from tempora.session import materialise

FEATURES = "features"
FIT_ROWS = 50_000


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="error")


def check_fit_input(train: DataFrame, features: list[str], target: str, validation: DataFrame | None = None) -> None:
    """Non-empty, numeric, complete, and the same features in both frames: one aggregate per frame."""
    if not features:
        raise GuardError("fit: no features")
    for name, df in (("training", train), ("validation", validation)):
        if df is None:
            continue
        needed = [*features, target] if name == "training" else features
        require_columns(df, needed, f"fit, {name} part")
        wrong = non_numeric_columns(df, needed)
        if wrong:
            raise GuardError(f"fit, {name} part: not numeric: {wrong}")
        row = df.agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(needed)]
        ).first()
        if not row["n"]:
            raise GuardError(f"fit, {name} part: no rows")
        gaps = [c for i, c in enumerate(needed) if row[f"m{i}"]]
        if gaps:
            raise GuardError(f"fit, {name} part: missing values in {gaps}")


def fit_rows(vectors: DataFrame) -> DataFrame:
    """Stored rows for an iterative fit: every pass reads them, so their plan must not run again. A pass over few rows should not be
    cut into many tasks, as each sends its own histograms; many rows are dealt out evenly, however few files hold them (FIT_ROWS a task)."""
    stored = materialise(vectors, "vectors")
    tasks = max(1, -(-stored.count() // FIT_ROWS))
    return stored.coalesce(1) if tasks == 1 else stored.repartition(tasks)


def fit(estimator, train: DataFrame, features: list[str], target: str) -> PipelineModel:
    """Assembler plus fitted estimator; the assembler keeps the feature list with the saved model."""
    stage = assembler(features)
    ready = stage.transform(train).select(FEATURES, F.col(target).cast("double").alias(target))
    model = estimator.setFeaturesCol(FEATURES).setLabelCol(target).fit(fit_rows(ready))
    return PipelineModel([stage, model])


def predict(
    model: Transformer, df: DataFrame, keep: list[str], target: str, name: str = "predicted"
) -> DataFrame:
    """Keys, ``actual`` and the prediction. Rows carry their key, nothing is matched by position."""
    scored = model.transform(df)
    return scored.select(*keep, F.col(target).cast("double").alias("actual"), F.col("prediction").alias(name))


def importance_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance), largest first. One row per feature."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    if len(names) != len(values):
        raise GuardError(f"{len(names)} feature names for {len(values)} importances")
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), F.asc("feature"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
