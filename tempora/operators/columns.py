"""Column guards, selections, filters and row predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tempora.errors import GuardError
from tempora.functions.casts import lenient_double, lenient_timestamp, nan_to_null
from tempora.schemas import CHANGED, DEMAND_NUMERIC_COLUMNS, SERIES, TARGET, TS

FLOATING = (T.DoubleType, T.FloatType)


def require_columns(df: DataFrame, required: list[str], stage: str = "input") -> None:
    """Schema-only guard; starts no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise GuardError(f"{stage}: required columns are absent: {missing}")


def require_rows(df: DataFrame, stage: str = "input") -> None:
    """Reads at most one row."""
    if df.isEmpty():
        raise GuardError(f"{stage}: no rows")


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def require_no_missing(df: DataFrame, columns: list[str], stage: str = "input") -> None:
    """One aggregate over the frame; raises when any listed column holds a missing value."""
    require_columns(df, columns, stage)
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns]).first()
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise GuardError(f"{stage}: missing values in {bad}")


def numeric_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    names = df.columns if columns is None else columns
    return [c for c in names if isinstance(df.schema[c].dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame, columns: list[str]) -> list[str]:
    numeric = set(numeric_columns(df, columns))
    return [c for c in columns if c not in numeric]


def feature_columns(df: DataFrame, ts: str = TS, target: str = TARGET, keys: tuple[str, ...] = ()) -> list[str]:
    """Everything except keys, timestamp and target, in frame order."""
    skip = {ts, target, *keys}
    return [c for c in df.columns if c not in skip]


def model_columns(df: DataFrame, series: tuple[str, ...] = (), ts: str = TS, target: str = TARGET) -> DataFrame:
    """The key, timestamp and target of a cleaned series."""
    wanted = [*series, ts, target]
    require_columns(df, wanted, "model columns")
    return df.select(*wanted)


def filter_series(df: DataFrame, value: str, column: str = SERIES, require_match: bool = False) -> DataFrame:
    """Rows of one series. With ``require_match`` an empty result raises and says how many series there are."""
    require_columns(df, [column], "series filter")
    out = df.filter(F.col(column) == value)
    if require_match and out.isEmpty():
        found = df.agg(F.count_distinct(column), F.min(column), F.max(column)).first()
        raise GuardError(
            f"no rows for {column}={value!r}; there are {found[0]} others, from {found[1]!r} to {found[2]!r} (distinct_values lists them)"
        )
    return out


def coerce_demand_types(
    df: DataFrame,
    timestamps: tuple[str, ...] = (TS, CHANGED),
    numbers: tuple[str, ...] = tuple(DEMAND_NUMERIC_COLUMNS),
) -> DataFrame:
    """Text to timestamps and doubles; unreadable values become null."""
    return df.withColumns(
        {**{c: lenient_timestamp(c) for c in timestamps}, **{c: lenient_double(c) for c in numbers}}
    )


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with a null or NaN in any column (lag and rolling warm-up)."""
    return df.dropna("any")


def rows_with_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    require_columns(df, columns, "missing rows")
    return df.filter(reduce(or_, [is_missing(df, c) for c in columns]))


def count_all_missing(df: DataFrame, columns: list[str], name: str = "all_null_rows") -> DataFrame:
    require_columns(df, columns, "all-missing rows")
    return df.agg(F.count_if(reduce(and_, [is_missing(df, c) for c in columns])).alias(name))


def replace_nan(df: DataFrame) -> DataFrame:
    """Map NaN to null in every floating column, once, at ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def with_residual(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    require_columns(df, [actual, predicted], "residual")
    return df.withColumn("residual", F.col(actual) - F.col(predicted))
