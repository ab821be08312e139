"""The stage reports. Each function returns a one-row DataFrame; ``enforce`` acts on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tempora.errors import DataQualityError
from tempora.functions.casts import lenient_double, lenient_timestamp
from tempora.functions.timeline import MINUTE
from tempora.operators.chunks import CHUNK_ROWS, SLOT
from tempora.operators.columns import is_missing, non_numeric_columns, numeric_columns, require_columns
from tempora.operators.dedup import duplicate_count
from tempora.operators.joins import key_coverage, split_overlap
from tempora.operators.timeseries import continuity, missing_intervals
from tempora.quality.profiles import (
    as_struct,
    counter_map,
    infinite_counters,
    is_infinite,
    is_non_finite,
    missing_counters,
    timestamp_profile,
)
from tempora.schemas import COMPARISON_COLUMNS, MINIMUM_MATCH_RATE, SERIES, TARGET, TS, WEATHER_COLUMNS
from tempora.session import materialise, scratch_path


def with_status(report: DataFrame, checks: dict[str, Column], warnings: dict[str, Column] | None = None) -> DataFrame:
    """Add ``failures``, ``warnings`` and ``status`` from named conditions."""

    def hits(named: dict[str, Column]) -> Column:
        found = F.array(*[F.when(cond, F.lit(text)) for text, cond in named.items()])
        return F.array_compact(found)

    out = report.withColumn("failures", hits(checks))
    status = F.when(F.size("failures") > 0, "FAIL")
    if warnings:
        out = out.withColumn("warnings", hits(warnings))
        status = status.when(F.size("warnings") > 0, "PASS_WITH_WARNINGS")
    return out.withColumn("status", status.otherwise("PASS"))


def enforce(report: DataFrame, path: str | None = None) -> dict:
    """Collect the one-row report, save it when a path is given, then raise on failure."""
    from tempora.sinks.reports import report_dict, write_report

    found = report_dict(report)
    if path:
        write_report(report.sparkSession, found, path)
    if found.get("failures"):
        raise DataQualityError(found.get("stage", "report"), found["failures"])
    return found


def _sum_map(name: str) -> Column:
    return F.aggregate(F.map_values(name), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _typed_timestamp(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, lenient_timestamp(ts)) if dict(df.dtypes)[ts] == "string" else df


def _timestamp_checks() -> dict[str, Column]:
    return {
        "Some timestamps are missing or unreadable.": F.col("timestamp.invalid_timestamp_count") > 0,
        "Some timestamps occur more than once.": F.col("timestamp.duplicate_timestamp_count") > 0,
    }


def series_report(
    df: DataFrame,
    ts: str = TS,
    keys: tuple[str, ...] = (SERIES, TS),
    step: int = 30 * MINUTE,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
    details: str | None = None,
) -> DataFrame:
    """Rows, range, duplicates, gaps and missing values per column. Informative only: never fails.

    Every missing interval is written to ``missing_intervals.csv`` below ``details`` (the shared scratch folder if none is
    given); the report holds their number and the table's path.
    """
    from tempora.sinks.tables import write_csv

    gaps = materialise(missing_intervals(df, ts, step, series, chunk_rows, slot), "gaps")
    path = f"{details or scratch_path(df.sparkSession, 'gap-details')}/missing_intervals.csv"
    write_csv(gaps, path, [*series, ts])
    return df.agg(
        F.lit("series").alias("stage"),
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("start_datetime"),
        F.max(ts).alias("end_datetime"),
        counter_map(missing_counters(df), keep_zero=True).alias("missing_values"),
    ).select(
        "stage",
        "rows",
        "start_datetime",
        "end_datetime",
        duplicate_count(df, list(keys)).scalar().alias("duplicate_intervals"),
        gaps.agg(F.count(F.lit(1))).scalar().alias("missing_interval_count"),
        F.lit(path).alias("missing_interval_table"),
        "missing_values",
    )


def demand_report(
    df: DataFrame,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    ordinal: str | Sequence[str] | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    require_columns(df, [*series, ts, target], "demand report")
    typed = _typed_timestamp(df, ts)
    y = F.col("__y")
    values = typed.select(lenient_double(target).alias("__y"))
    values = values.select(F.when(~F.isnan("__y"), F.col("__y")).alias("__y"))
    report = values.agg(
        F.lit("demand").alias("stage"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.struct(
            F.count_if(y.isNull()).alias("missing_or_non_numeric_count"),
            F.count_if(is_infinite(y)).alias("infinite_count"),
            F.count_if(y <= 0).alias("non_positive_count"),
            F.min(y).alias("minimum"),
            F.max(y).alias("maximum"),
            F.avg(y).alias("mean"),
        ).alias("target"),
    ).withColumn("timestamp", as_struct(timestamp_profile(typed, ts, series, ordinal, chunk_rows, slot)))
    checks = {
        "The demand frame has no rows.": F.col("row_count") == 0,
        **_timestamp_checks(),
        "Some target values are missing or not numeric.": F.col("target.missing_or_non_numeric_count") > 0,
        "Some target values are infinite.": F.col("target.infinite_count") > 0,
    }
    return with_status(report, checks)


def weather_report(
    df: DataFrame,
    ts: str = TS,
    series: tuple[str, ...] = (),
    ordinal: str | Sequence[str] | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    require_columns(df, [*series, ts], "weather report")
    typed = _typed_timestamp(df, ts)
    features = [c for c in df.columns if c not in {ts, *series}]
    report = (
        typed.agg(
            F.lit("weather").alias("stage"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(len(features)).alias("weather_feature_count"),
            counter_map(missing_counters(typed, features)).alias("missing_values_by_column"),
            counter_map(infinite_counters(typed, features)).alias("infinite_values_by_column"),
        )
        .withColumn("missing_value_count", _sum_map("missing_values_by_column"))
        .withColumn("timestamp", as_struct(timestamp_profile(typed, ts, series, ordinal, chunk_rows, slot)))
    )
    checks = {
        "The weather frame has no rows.": F.col("row_count") == 0,
        **_timestamp_checks(),
        "Some weather values are infinite.": F.size("infinite_values_by_column") > 0,
    }
    return with_status(report, checks)


def hourly_weather_report(
    df: DataFrame,
    columns: list[str],
    step: int,
    ts: str = TS,
    series: tuple[str, ...] = (),
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    """Raw companion series: duplicates, missing timestamps and values, types, regular step."""
    require_columns(df, [*series, ts, *columns], "weather input")
    wrong = non_numeric_columns(df, columns)
    report = (
        df.agg(
            F.lit("weather_input").alias("stage"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(ts).isNull()).alias("invalid_timestamp_count"),
            counter_map(missing_counters(df, columns)).alias("missing_values_by_column"),
            F.array(*[F.lit(c) for c in wrong]).cast("array<string>").alias("non_numeric_columns"),
        )
        .withColumn("duplicate_timestamp_count", duplicate_count(df, [*series, ts]).scalar())
        .withColumn("steps", as_struct(continuity(df, ts, step, series, chunk_rows, slot)))
    )
    checks = {
        "The weather input has no rows.": F.col("row_count") == 0,
        "Some weather timestamps occur more than once.": F.col("duplicate_timestamp_count") > 0,
        "Some weather timestamps are missing.": F.col("invalid_timestamp_count") > 0,
        "Some weather columns are not numeric.": F.size("non_numeric_columns") > 0,
        "Some weather values are missing.": F.size("missing_values_by_column") > 0,
        f"Weather rows are not {step // MINUTE} minutes apart.": F.col("steps.unexpected_intervals") > 0,
    }
    return with_status(report, checks)


def merge_report(
    demand: DataFrame,
    weather: DataFrame,
    merged: DataFrame,
    keys: list[str] | None = None,
    columns: list[str] | None = None,
    minimum_match_rate: float = MINIMUM_MATCH_RATE,
    demand_keys: list[str] | None = None,
) -> DataFrame:
    """Counts, coverage and gaps of the merge. ``demand_keys`` makes a demand row unique, by default the join keys."""
    keys = keys or [TS]
    expected = WEATHER_COLUMNS if columns is None else columns
    for name, df in (("demand", demand), ("weather", weather), ("merged", merged)):
        require_columns(df, keys, f"merge report, {name}")
    present = [c for c in expected if c in merged.columns]
    ts = keys[-1]
    rows = merged.agg(
        F.lit("demand_weather_merge").alias("stage"),
        F.count(F.lit(1)).alias("merged_rows"),
        F.count_if(F.col(ts).isNull()).alias("invalid_merged_timestamp_count"),
        counter_map(missing_counters(merged, present)).alias("missing_weather_values_by_column_after_merge"),
    )
    report = (
        rows.withColumns(
            {
                "demand_rows_before_merge": demand.agg(F.count(F.lit(1))).scalar(),
                "weather_rows_before_merge": weather.agg(F.count(F.lit(1))).scalar(),
                "duplicate_merged_timestamp_count": duplicate_count(merged, demand_keys or keys).scalar(),
                "coverage": as_struct(key_coverage(demand, weather, keys)),
            }
        )
        .select(
            "stage",
            "demand_rows_before_merge",
            "weather_rows_before_merge",
            "merged_rows",
            (F.col("merged_rows") - F.col("demand_rows_before_merge")).alias("row_difference_vs_demand"),
            F.col("coverage.left_keys").alias("unique_demand_timestamps"),
            F.col("coverage.right_keys").alias("unique_weather_timestamps"),
            F.col("coverage.matched").alias("matched_timestamp_count"),
            F.col("coverage.unmatched").alias("unmatched_demand_timestamp_count"),
            F.col("coverage.extra").alias("extra_weather_timestamp_count"),
            F.col("coverage.match_rate").alias("match_rate"),
            F.lit(float(minimum_match_rate)).alias("minimum_required_match_rate"),
            "duplicate_merged_timestamp_count",
            "invalid_merged_timestamp_count",
            F.array(*[F.lit(c) for c in expected]).cast("array<string>").alias("weather_columns_expected"),
            F.array(*[F.lit(c) for c in present]).cast("array<string>").alias("weather_columns_present_after_merge"),
            _sum_map("missing_weather_values_by_column_after_merge").alias("missing_weather_value_count_after_merge"),
            "missing_weather_values_by_column_after_merge",
        )
    )
    checks = {
        f"The match rate is below {minimum_match_rate:.2%}.": F.col("match_rate") < minimum_match_rate,
        "The merge produced repeated timestamps.": F.col("duplicate_merged_timestamp_count") > 0,
        "The merged frame has missing timestamps.": F.col("invalid_merged_timestamp_count") > 0,
        "The merge added demand rows.": F.col("row_difference_vs_demand") > 0,
        "The merged frame lacks weather columns.": F.lit(len(present) != len(expected)),
    }
    warnings = {
        "The merge lost demand rows.": F.col("row_difference_vs_demand") < 0,
        "The merged frame has missing weather values.": F.col("missing_weather_value_count_after_merge") > 0,
        "Some demand timestamps have no weather row.": F.col("unmatched_demand_timestamp_count") > 0,
    }
    return with_status(report, checks, warnings)


def training_report(
    df: DataFrame,
    ts: str = TS,
    target: str = TARGET,
    series: tuple[str, ...] = (),
    ordinal: str | Sequence[str] | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
    slot: str = SLOT,
) -> DataFrame:
    require_columns(df, [*series, ts, target], "training report")
    features = [c for c in df.columns if c not in {ts, target, *series}]
    wrong = non_numeric_columns(df, features)
    report = (
        df.agg(
            F.lit("training_dataset").alias("stage"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(len(features)).alias("feature_count"),
            F.array(*[F.lit(c) for c in features]).cast("array<string>").alias("feature_columns"),
            F.lit(target in features).alias("target_in_features"),
            F.lit(ts in features).alias("timestamp_in_features"),
            F.array(*[F.lit(c) for c in wrong]).cast("array<string>").alias("non_numeric_features"),
            counter_map(missing_counters(df)).alias("missing_values_by_column"),
            counter_map(infinite_counters(df, features)).alias("infinite_values_by_column"),
        )
        .withColumn("missing_value_count", _sum_map("missing_values_by_column"))
        .withColumn("timestamp", as_struct(timestamp_profile(df, ts, series, ordinal, chunk_rows, slot)))
    )
    checks = {
        "The training frame has no rows.": F.col("row_count") == 0,
        "The training frame has no features.": F.col("feature_count") == 0,
        "Some features are not numeric.": F.size("non_numeric_features") > 0,
        "Some training values are missing.": F.col("missing_value_count") > 0,
        "Some training values are infinite.": F.size("infinite_values_by_column") > 0,
        **_timestamp_checks(),
        "Training timestamps are out of order.": ~F.col("timestamp.is_monotonic_increasing"),
    }
    return with_status(report, checks)


def split_report(
    full: DataFrame,
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    features: list[str],
    ts: str = TS,
    target: str = TARGET,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Totals, overlap, order and leakage checks. ``keys`` are the series: overlap and order are judged inside each one."""
    parts = {"train": train, "validation": validation, "test": test}
    for name, df in {"full": full, **parts}.items():
        require_columns(df, [ts, target], f"split report, {name}")
    absent = [c for c in features if c not in full.columns]
    tagged = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("part"), *keys, ts)
        tagged = one if tagged is None else tagged.unionByName(one)
    each = tagged.groupBy(*keys).agg(
        *[F.count_if(F.col("part") == p).alias(f"{p}_n") for p in parts],
        *[F.min(F.when(F.col("part") == p, F.col(ts))).alias(f"{p}_lo") for p in parts],
        *[F.max(F.when(F.col("part") == p, F.col(ts))).alias(f"{p}_hi") for p in parts],
    )
    stats = each.agg(
        *[F.coalesce(F.sum(f"{p}_n"), F.lit(0)).alias(f"{p}_row_count") for p in parts],
        *[F.min(f"{p}_lo").alias(f"{p}_start") for p in parts],
        *[F.max(f"{p}_hi").alias(f"{p}_end") for p in parts],
        # A series that lacks a part has no order to break; a part without any row fails below.
        F.bool_and(F.col("train_hi") < F.col("validation_lo")).alias("__first"),
        F.bool_and(F.col("validation_hi") < F.col("test_lo")).alias("__second"),
    )
    total = F.col("train_row_count") + F.col("validation_row_count") + F.col("test_row_count")
    report = (
        stats.withColumns(
            {
                "full_row_count": full.agg(F.count(F.lit(1))).scalar(),
                "timestamp_overlap_counts": as_struct(split_overlap(parts, [*keys, ts])),
            }
        )
        .select(
            F.lit("chronological_split").alias("stage"),
            "full_row_count",
            *[f"{p}_row_count" for p in parts],
            total.alias("split_row_total"),
            (total == F.col("full_row_count")).alias("row_total_matches_full_dataset"),
            F.lit(len(features)).alias("feature_count"),
            F.array(*[F.lit(c) for c in absent]).cast("array<string>").alias("missing_feature_columns"),
            F.lit(target not in features).alias("target_excluded_from_features"),
            F.lit(ts not in features).alias("timestamp_excluded_from_features"),
            "timestamp_overlap_counts",
            F.coalesce("__first", F.lit(False)).alias("train_before_validation"),
            F.coalesce("__second", F.lit(False)).alias("validation_before_test"),
            F.struct(*[f"{p}_{edge}" for p in parts for edge in ("start", "end")]).alias("boundaries"),
        )
    )
    o = "timestamp_overlap_counts"
    overlap = F.col(f"{o}.train_validation") + F.col(f"{o}.train_test") + F.col(f"{o}.validation_test")
    checks = {
        "The parts do not add up to the full frame.": ~F.col("row_total_matches_full_dataset"),
        "The parts share timestamps.": overlap > 0,
        "Training does not end before validation.": ~F.col("train_before_validation"),
        "Validation does not end before test.": ~F.col("validation_before_test"),
        "Some features do not exist.": F.size("missing_feature_columns") > 0,
        "The target is among the features.": ~F.col("target_excluded_from_features"),
        "The timestamp is among the features.": ~F.col("timestamp_excluded_from_features"),
        "A part has no rows.": F.least(*[f"{p}_row_count" for p in parts]) == 0,
    }
    return with_status(report, checks)


def model_output_report(
    comparison: DataFrame, predictions: DataFrame, metrics: DataFrame, selected: str | Column
) -> DataFrame:
    """Checks of the leaderboard, the test predictions and the one-row test metrics."""
    absent = [c for c in COMPARISON_COLUMNS if c not in comparison.columns]
    shown = [c for c in ("actual", "predicted", "residual") if c in predictions.columns]
    chosen = F.lit(selected) if isinstance(selected, str) else selected
    finite = F.map_from_entries(
        F.array(*[F.struct(F.lit(c), ~is_non_finite(metrics, c)) for c in numeric_columns(metrics)])
    )
    names = comparison.agg(F.collect_set("model")) if "model" in comparison.columns else None
    listed = names.scalar() if names is not None else F.array().cast("array<string>")
    report = (
        predictions.agg(
            F.lit("model_outputs").alias("stage"),
            F.count(F.lit(1)).alias("test_prediction_row_count"),
            counter_map(missing_counters(predictions)).alias("__missing"),
            counter_map({c: is_non_finite(predictions, c) for c in shown}).alias("non_finite_prediction_counts"),
        )
        .withColumns(
            {
                "selected_model": chosen,
                "comparison_row_count": comparison.agg(F.count(F.lit(1))).scalar(),
                "missing_comparison_columns": F.array(*[F.lit(c) for c in absent]).cast("array<string>"),
                "test_prediction_missing_value_count": _sum_map("__missing"),
                "finite_test_metrics": metrics.select(finite).scalar(),
            }
        )
        .withColumn("selected_model_present_in_comparison", F.array_contains(listed, F.col("selected_model")))
        .drop("__missing")
    )
    bad_metric = F.exists(F.map_values("finite_test_metrics"), lambda ok: ~ok)
    checks = {
        "The leaderboard lacks columns.": F.size("missing_comparison_columns") > 0,
        "The selected model is not on the leaderboard.": ~F.col("selected_model_present_in_comparison"),
        "There are no test predictions.": F.col("test_prediction_row_count") == 0,
        "Some test predictions are missing.": F.col("test_prediction_missing_value_count") > 0,
        "Some test predictions are not finite.": F.size("non_finite_prediction_counts") > 0,
        "Some test metrics are not finite.": F.coalesce(bad_metric, F.lit(True)),
    }
    return with_status(report, checks)


__all__ = [
    "demand_report",
    "enforce",
    "hourly_weather_report",
    "is_missing",
    "merge_report",
    "model_output_report",
    "series_report",
    "split_report",
    "training_report",
    "weather_report",
    "with_status",
]
