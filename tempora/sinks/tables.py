"""Table writers. Sorting happens only here, and only when asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tempora.operators.columns import rows_with_missing
from tempora.operators.joins import unmatched_keys
from tempora.operators.setops import chronological
from tempora.schemas import TS, WEATHER_COLUMNS


def write_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """CSV with a header; a directory of part files, range-sorted when ``order_by`` is given."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet; partitioning by series gives readers partition pruning."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_merge_details(
    demand: DataFrame,
    weather: DataFrame,
    merged: DataFrame,
    directory: str,
    keys: list[str] | None = None,
    columns: list[str] | None = None,
) -> None:
    """The rows behind the merge report: unmatched and extra keys, and rows with weather gaps."""
    keys = keys or [TS]
    expected = WEATHER_COLUMNS if columns is None else columns
    present = [c for c in expected if c in merged.columns]
    write_csv(unmatched_keys(demand, weather, keys), f"{directory}/unmatched_demand_timestamps", keys)
    write_csv(unmatched_keys(weather, demand, keys), f"{directory}/extra_weather_timestamps", keys)
    if present:
        write_csv(rows_with_missing(merged, present), f"{directory}/merged_rows_with_missing_weather", keys)


def write_training_table(df: DataFrame, directory: str, ts: str = TS, series: tuple[str, ...] = ()) -> None:
    """Parquet for reuse and CSV for exchange, in chronological order."""
    ordered = chronological(df, ts, series)
    write_parquet(ordered, f"{directory}/training_dataset.parquet", list(series) or None)
    write_csv(ordered, f"{directory}/training_dataset.csv")


def read_csv_like(df: DataFrame, path: str) -> DataFrame:
    """Read a CSV written by :func:`write_csv` with the schema of ``df``."""
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


