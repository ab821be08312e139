"""Standardisation with statistics of the training rows only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tempora.errors import GuardError
from tempora.operators.columns import require_columns


def _safe(std: Column) -> Column:
    return F.when(std == 0, F.lit(1.0)).otherwise(std)


def scale_with(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """Scale lazily: the training statistics are one aggregate, read as a scalar subquery."""
    require_columns(df, columns, "scaling")
    require_columns(train, columns, "scaling, training part")
    stats = train.agg(
        F.struct(
            *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
        ).alias("s")
    )
    rows = df.withColumn("__s", stats.scalar())
    scaled = {c: (F.col(c) - F.col(f"__s.{c}.mean")) / _safe(F.col(f"__s.{c}.std")) for c in columns}
    return rows.withColumns(scaled).select(*df.columns)


@dataclass(frozen=True)
class FittedScaler:
    """Means and population deviations per column (two numbers per feature)."""

    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Scaled columns in place, or next to the originals under ``prefix``."""
        require_columns(df, list(self.means), "scaling")
        return df.withColumns(
            {prefix + c: (F.col(c) - F.lit(self.means[c])) / F.lit(self.stds[c] or 1.0) for c in self.means}
        )


def fit_scaler(train: DataFrame, columns: list[str]) -> FittedScaler:
    """One aggregate job; only the statistics reach the driver."""
    require_columns(train, columns, "scaling")
    aggs = [f(F.col(c).cast("double")).alias(f"{tag}{i}") for i, c in enumerate(columns) for tag, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    if not row["n"]:
        raise GuardError("scaling: the training part is empty")
    return FittedScaler(
        {c: row[f"m{i}"] for i, c in enumerate(columns)}, {c: row[f"s{i}"] for i, c in enumerate(columns)}
    )
