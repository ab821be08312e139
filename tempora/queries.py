"""Registered queries: every operator applied to the driver tables.

The tables hold no demand or weather, so they are derived: ``events`` summed per half hour (per event
type, or over all types) is the demand, hourly event statistics are the weather. All numbers start
as integer cents, which keeps sums exact on both engines.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tempora.errors import DataQualityError, GuardError
from tempora.functions.calendar import calendar_columns, cyclical_columns
from tempora.functions.casts import strict_double, strict_timestamp
from tempora.functions.timeline import DAY, HOUR, MINUTE, micros, shift
from tempora.models.frames import check_fit_input, importance_table, load_model, predict, save_model
from tempora.models.linear import fit_linear, fit_ridge
from tempora.models.search import tune_boosted
from tempora.models.trees import fit_boosted, fit_boosted_default, fit_random_forest
from tempora.operators import columns as col_ops
from tempora.operators import dedup, joins, metrics, setops
from tempora.operators.scaling import fit_scaler, scale_with
from tempora.operators.split import chronological_split, expanding_folds, split_part
from tempora.operators.timeseries import (
    continuity,
    expand_backwards,
    missing_intervals,
    require_continuous,
    resample_sum,
    upsample_linear,
)
from tempora.operators.windows import (
    add_differences,
    add_far_lags,
    add_history_features,
    add_lag_features,
    add_rolling_features,
    add_time_lags,
    order_check,
)
from tempora.plans.demand import clean_demand, demand_features
from tempora.plans.forecast import BOOSTED, Budget, final_forecast, fit_candidates, split_table
from tempora.plans.training import training_table
from tempora.plans.weather import clean_weather, type_weather, weather_features
from tempora.quality import profiles, reports
from tempora.schemas import (
    CHANGED,
    CONTINUOUS_WEATHER,
    HOURLY_VARIABLES,
    SERIES,
    SOURCE_FILE,
    TARGET,
    TS,
    WEATHER_COLUMNS,
)
from tempora.session import materialise, scratch_path, scratch_scope
from tempora.sinks.runs import MANIFEST, RunFolder, path_exists, published, read_json_report
from tempora.sinks.tables import read_csv_like, write_csv, write_merge_details, write_parquet, write_training_table
from tempora.sources.archives import parse_archives
from tempora.sources.columnar import read_columnar_json
from tempora.sources.tagged import POSITION, ingest_summary, read_tagged_csv

Query = Callable[[SparkSession, str], DataFrame]
REGION = (SERIES,)
HALF_HOUR = 30 * MINUTE

# Forest, default boosting and the whole comparison run at the library's sizes (25 draws x 4 folds of up to 1200 rounds).
# `gbt_tuned` and `final_forecast` draw 2 candidates from this smaller space, over all folds.
SEARCH = {"n_estimators": [5, 10], "learning_rate": [0.1, 0.3], "max_depth": [3, 4], "subsample": [0.8, 1.0]}
BUDGET = Budget(search_iterations=2, search_space=SEARCH)


# --- derived inputs ------------------------------------------------------------------------------


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def half_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Half-hourly demand per event type; types have gaps."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", SERIES)
    return resample_sum(ev, "ts", cents(), HALF_HOUR, TARGET, TS, REGION)


def half_total(spark: SparkSession, sf: str) -> DataFrame:
    """One long half-hourly series over all types."""
    return resample_sum(table(spark, sf, "events"), "ts", cents(), HALF_HOUR, TARGET, TS)


def hourly_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly observations under the raw variable names."""
    hour = F.window("ts", "1 hour").getField("start").alias("time")
    base = table(spark, sf, "events").groupBy(hour).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents()).alias("s"), F.min(cents()).alias("lo"), F.max(cents()).alias("hi")
    )
    s, n, lo, hi = F.col("s"), F.col("n"), F.col("lo"), F.col("hi")
    return base.select(
        "time",
        ((s % 4500) / 100.0).alias("temperature_2m"),
        ((hi % 10000) / 100.0).alias("relative_humidity_2m"),
        ((lo % 4500) / 100.0).alias("apparent_temperature"),
        F.when(n % 3 == 0, (hi % 800) / 100.0).otherwise(0.0).alias("precipitation"),
        (n % 100).cast("double").alias("cloud_cover"),
        ((s % 700) / 10.0).alias("wind_speed_10m"),
        (F.greatest((s % 9000) - 3000, F.lit(0)) / 10.0).alias("shortwave_radiation_instant"),
    )


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return type_weather(hourly_raw(spark, sf))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Half-hourly weather. The derived hours may have gaps, so regularity is not enforced here."""
    return clean_weather(hourly_raw(spark, sf), require_regular=False)


def training(spark: SparkSession, sf: str) -> DataFrame:
    return training_table(half_total(spark, sf), weather(spark, sf))


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    """Fixed number of decimals by plain arithmetic, the same on both engines."""
    scale = f"1e{digits}d"
    return df.withColumns({c: F.expr(f"floor(`{c}` * {scale} + 0.5d) / {scale}") for c in names})


# --- sources --------------------------------------------------------------------------------------


def _tagged_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(day, seq, value): tagged CSV text of the demand, one report per day."""
    stamp = F.date_format(F.col(TS), "yyyy/MM/dd HH:mm:ss")
    day = F.date_format(F.col(TS), "yyyy-MM-dd")
    data = half_by_type(spark, sf).select(
        day.alias("day"),
        F.lit(2).alias("seq"),
        F.concat_ws(
            ",",
            F.lit("D,OPERATIONAL_DEMAND,ACTUAL,3"),
            SERIES,
            F.concat(F.lit('"'), stamp, F.lit('"')),
            TARGET,
            F.lit("0"),
            F.lit("0"),
            F.concat(F.lit('"'), stamp, F.lit('"')),
        ).alias("value"),
    )
    frame = [
        (0, "C,SYSTEM,REPORT,OWNER,PUBLIC"),
        (
            1,
            "I,OPERATIONAL_DEMAND,ACTUAL,3,REGIONID,INTERVAL_DATETIME,OPERATIONAL_DEMAND,"
            "OPERATIONAL_DEMAND_ADJUSTMENT,WDR_ESTIMATE,LASTCHANGED",
        ),
        (3, 'C,"END OF REPORT"'),
    ]
    around = F.array(*[F.struct(F.lit(s).alias("seq"), F.lit(v).alias("value")) for s, v in frame])
    edges = data.select("day").distinct().select("day", F.explode(around).alias("e")).select("day", "e.seq", "e.value")
    return data.unionByName(edges)


def ingest_tagged_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tagged")
    lines = _tagged_lines(spark, sf).repartition("day").sortWithinPartitions("day", "seq")
    # A one-column CSV without quoting writes the lines as they are.
    lines.select("value").write.option("quote", "\u0000").option("sep", "\u0001").csv(path)
    return read_tagged_csv(spark, path).select("RECORD_TYPE", "VERSION", SERIES, TS, TARGET, CHANGED)


def ingest_quoted_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose quoted note goes over several lines, some of which look like records."""
    path = scratch_path(spark, "notes")
    ev = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.col("event_id").alias("seq"), "event_type")
    note = F.concat(F.lit('"'), "event_type", F.lit('\nD,x,""quoted"" '), F.col("seq").cast("string"), F.lit('\n"'))
    record = F.concat_ws(",", F.lit("D,NOTES,ACTUAL,3"), "seq", F.when(F.col("seq") % 3 == 0, note).otherwise(F.col("event_type")), F.lit("z"))
    head = ev.select("day").distinct().select("day", F.lit(-1).cast("bigint").alias("seq"), F.lit("I,NOTES,ACTUAL,3,ID,NOTE,END").alias("value"))
    lines = ev.select("day", "seq", record.alias("value")).unionByName(head).select("day", "seq", F.posexplode(F.split("value", "\n")).alias("line", "value"))
    dealt = lines.repartition("day").sortWithinPartitions("day", "seq", "line")
    dealt.select("value").write.option("quote", "\u0000").option("sep", "\u0001").option("emptyValue", "").csv(path)
    return read_tagged_csv(spark, path).select("ID", "NOTE", "END")


def _zip_day(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
    """The archive of one day and series, inside one of its month."""
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w", zipfile.ZIP_DEFLATED) as month:
        for day, rows in lines.sort_values(["day", "seq", "value"]).groupby("day"):
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as daily:
                daily.writestr(f"{day}.CSV", "\r\n".join(rows["value"]))
            month.writestr(f"{day}.zip", inner.getvalue())
    return pd.DataFrame({"name": [f"{key[1][:7]}.zip"], "content": [outer.getvalue()]})


def _archives(spark: SparkSession, sf: str) -> DataFrame:
    """One archive per day and series, each with its own frame of records."""
    lines = _tagged_lines(spark, sf)
    series = F.when(F.col("seq") == 2, F.split("value", ",")[4])
    data = lines.withColumn("series", series).where("seq = 2")
    frame = lines.where("seq <> 2").join(data.select("day", "series").distinct(), "day").select(*data.columns)
    parts = data.unionByName(frame).groupBy("series", "day").applyInPandas(_zip_day, "name string, content binary")
    return materialise(parts, "archives")


def ingest_nested_zip(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean_demand(parse_archives(_archives(spark, sf)), check=False)
    return rows.select(SERIES, TS, TARGET, CHANGED, SOURCE_FILE)


def ingest_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_summary(parse_archives(_archives(spark, sf)))


def _payload_path(spark: SparkSession, sf: str) -> str:
    """Columnar JSON documents, one per day (at most 24 observations each)."""
    raw = hourly_raw(spark, sf)
    named = F.struct(F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"), *HOURLY_VARIABLES)
    days = raw.groupBy(F.to_date("time").alias("d")).agg(F.sort_array(F.collect_list(named)).alias("o"))
    arrays = F.struct(*[F.col(f"o.{v}").alias(v) for v in ["time", *HOURLY_VARIABLES]])
    documents = days.select(
        F.day("d").cast("double").alias("latitude"),
        F.month("d").cast("double").alias("longitude"),
        F.lit(0.0).alias("elevation"),
        F.lit("UTC+10").alias("timezone"),
        F.lit("AEST").alias("timezone_abbreviation"),
        F.lit(36000).alias("utc_offset_seconds"),
        F.create_map(F.lit("temperature_2m"), F.lit("°C")).alias("hourly_units"),
        arrays.alias("hourly"),
    )
    path = scratch_path(spark, "columnar")
    documents.write.json(path)
    return path


def ingest_columnar_json(spark: SparkSession, sf: str) -> DataFrame:
    return read_columnar_json(spark, _payload_path(spark, sf), multi_line=False)[0]


def weather_metadata(spark: SparkSession, sf: str) -> DataFrame:
    meta = read_columnar_json(spark, _payload_path(spark, sf), multi_line=False)[1]
    return meta.select(
        "latitude",
        "longitude",
        "elevation",
        "timezone",
        "timezone_abbreviation",
        "utc_offset_seconds",
        F.col("hourly_units")["temperature_2m"].alias("temperature_unit"),
    )


# --- projections, casts, filters -------------------------------------------------------------------


def project_model_columns(spark: SparkSession, sf: str) -> DataFrame:
    wide = half_by_type(spark, sf).withColumns(calendar_columns())
    return col_ops.model_columns(wide, REGION)


def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority"))
        .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"))
        .alias(TS),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy/M/d H:m:s"))
        .alias(CHANGED),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias(TARGET),
    )
    return col_ops.coerce_demand_types(text, numbers=(TARGET,))


def residuals(spark: SparkSession, sf: str) -> DataFrame:
    lagged = add_lag_features(half_by_type(spark, sf), [1], series=REGION).dropna()
    named = lagged.select(SERIES, TS, F.col(TARGET).alias("actual"), F.col("lag_1").alias("predicted"))
    return col_ops.with_residual(named)


def _baseline_rows(spark: SparkSession, sf: str) -> DataFrame:
    lagged = add_lag_features(half_total(spark, sf)).dropna()
    return metrics.baseline_predictions(above_zero(lagged))


def above_zero(df: DataFrame) -> DataFrame:
    """All rows, the target one cent higher: sums of cents may be 0, which has no MAPE."""
    return df.withColumn(TARGET, F.col(TARGET) + 1)


def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.evaluate_models(_baseline_rows(spark, sf))


def metric_improvement(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.metric_improvement(_comparison(spark, sf), "previous_week")
    return rounded(out.select("model", "MAE", "MAE_improvement"), ["MAE", "MAE_improvement"], 4)


def filter_series(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.filter_series(half_by_type(spark, sf), "click")


def drop_warmup(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.drop_missing(add_lag_features(half_by_type(spark, sf), series=REGION))


def _hourly_join(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join_one_to_one(half_by_type(spark, sf), hourly(spark, sf), [TS], check=False)


def rows_with_missing(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.rows_with_missing(_hourly_join(spark, sf), CONTINUOUS_WEATHER).select(SERIES, TS, TARGET)


def all_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.count_all_missing(_hourly_join(spark, sf), CONTINUOUS_WEATHER)


def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "customer").select("c_custkey", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"))
    spent = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    updates = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(spent)
    return dedup.upsert(base, updates, ["c_custkey"])


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.null_counts(add_history_features(half_by_type(spark, sf), series=REGION))


# --- joins -------------------------------------------------------------------------------------------


def join_left_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    return joins.attach_weather(half_total(spark, sf), weather(spark, sf), check=False)


def join_inner_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    source = hourly(spark, sf)
    smooth = upsample_linear(source, CONTINUOUS_WEATHER)
    return joins.join_one_to_one(smooth, expand_backwards(source), [TS], "inner", check=False)


def unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unmatched_keys(half_by_type(spark, sf), hourly(spark, sf), [TS])


def extra_keys(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unmatched_keys(weather(spark, sf), half_by_type(spark, sf), [TS])


def match_rate(spark: SparkSession, sf: str) -> DataFrame:
    return joins.key_coverage(half_by_type(spark, sf), hourly(spark, sf), [TS])


def merge_report(spark: SparkSession, sf: str) -> DataFrame:
    demand, companion = materialise(half_by_type(spark, sf)), materialise(weather(spark, sf))
    merged = materialise(joins.attach_weather(demand, companion, demand_keys=[SERIES, TS]))
    out = reports.merge_report(demand, companion, merged, demand_keys=[SERIES, TS])
    return out.select(
        "demand_rows_before_merge",
        "weather_rows_before_merge",
        "merged_rows",
        "row_difference_vs_demand",
        "matched_timestamp_count",
        "unmatched_demand_timestamp_count",
        "extra_weather_timestamp_count",
        "match_rate",
        "duplicate_merged_timestamp_count",
        "missing_weather_value_count_after_merge",
        "status",
    )


def split_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps that the parts of all series share: series end at different times, so their parts overlap."""
    labelled = chronological_split(half_by_type(spark, sf), series=REGION)
    return joins.split_overlap({p: split_part(labelled, p).select(TS) for p in ("train", "validation", "test")}, [TS])


# --- aggregates --------------------------------------------------------------------------------------


def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(len(col_ops.numeric_columns(df))).alias("numeric_column_count"),
    )


def target_profile(spark: SparkSession, sf: str) -> DataFrame:
    return reports.demand_report(half_by_type(spark, sf), series=REGION).select("row_count", "target.*")


def infinite_counts(spark: SparkSession, sf: str) -> DataFrame:
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax"))
    negative = F.when(F.col("l_tax") == 0, F.lit(float("-inf"))).otherwise(F.col("l_discount"))
    df = table(spark, sf, "lineitem").select("l_quantity", ratio.alias("ratio"), negative.alias("negative"))
    return profiles.infinite_counts(df)


def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_count(table(spark, sf, "events"), ["user_id", "event_type"])


def distinct_series(spark: SparkSession, sf: str) -> DataFrame:
    return setops.distinct_values(half_by_type(spark, sf), SERIES)


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The most common distances between consecutive timestamps."""
    counts = profiles.interval_counts(half_by_type(spark, sf), TS, REGION)
    top = counts.orderBy(F.desc("n"), F.asc("step_micros")).limit(profiles.TOP_INTERVALS)
    return top.select(profiles.interval_text("step_micros").alias("step"), "n")


def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts", "value")
    return dedup.drop_exact_duplicates(ev.unionByName(ev))


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedup.latest_per_key(ev, ("user_id", "event_type"), "ts", ("event_id",))


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500).alias("predicted")
    )
    return rounded(metrics.regression_metrics(pairs), ["MAE", "RMSE", "MAPE", "R2"], 4)


def evaluate_models(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_comparison(spark, sf), ["MAE", "RMSE", "MAPE", "R2"])


def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    scores = table(spark, sf, "events").groupBy(F.col("event_type").alias("candidate"), "user_id").agg(
        F.sum(cents()).cast("double").alias("validation_MAE"),
        F.min(cents()).cast("double").alias("training_MAE"),
        F.count(F.lit(1)).cast("double").alias("fit_time"),
    )
    out = metrics.cv_summary(scores)
    return rounded(out, ["mean_validation_MAE", "std_validation_MAE", "mean_training_MAE", "mean_fit_time"], 4)


def select_best(spark: SparkSession, sf: str) -> DataFrame:
    best = metrics.select_best(_comparison(spark, sf), ["previous_day", "previous_week"])
    return rounded(best, ["MAE"])


# --- windows and time series ---------------------------------------------------------------------------


def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    return add_lag_features(half_by_type(spark, sf), series=REGION)


def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    out = add_rolling_features(half_by_type(spark, sf), series=REGION)
    return rounded(out, ["rolling_std_4", "rolling_std_48"], 4)


def diff_features(spark: SparkSession, sf: str) -> DataFrame:
    changes = {"temperature_change_1h": 2, "temperature_change_3h": 6}
    return add_differences(weather(spark, sf).select(TS, "temperature"), "temperature", changes)


def interval_continuity(spark: SparkSession, sf: str) -> DataFrame:
    return continuity(half_by_type(spark, sf), TS, HALF_HOUR, REGION)


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """One value per event type and instant: rows grow with the table, series are long."""
    ev = table(spark, sf, "events").groupBy(F.col("event_type").alias(SERIES), F.col("ts").alias(TS))
    return ev.agg(F.sum(cents()).alias(TARGET))


RAW_CHUNK = 500  # rows of a chunk, far below the length of a series


def lag_features_raw(spark: SparkSession, sf: str) -> DataFrame:
    return add_lag_features(raw_events(spark, sf), series=REGION, chunk_rows=RAW_CHUNK)


def rolling_features_raw(spark: SparkSession, sf: str) -> DataFrame:
    out = add_rolling_features(raw_events(spark, sf), series=REGION, chunk_rows=RAW_CHUNK)
    return rounded(out, ["rolling_std_4", "rolling_std_48"], 3)


def lag_by_time(spark: SparkSession, sf: str) -> DataFrame:
    return add_time_lags(half_by_type(spark, sf), {"hour_before": HOUR, "day_before": DAY}, series=REGION)


def lag_far(spark: SparkSession, sf: str) -> DataFrame:
    """Lags beyond the chunks that the raw windows use."""
    return add_far_lags(raw_events(spark, sf), [RAW_CHUNK + 1, 3 * RAW_CHUNK], series=REGION, block_rows=RAW_CHUNK)


def chronological_split_raw(spark: SparkSession, sf: str) -> DataFrame:
    return chronological_split(raw_events(spark, sf), series=REGION)


def missing_intervals_raw(spark: SparkSession, sf: str) -> DataFrame:
    minutes = raw_events(spark, sf).select(SERIES, F.date_trunc("minute", TS).cast("timestamp_ntz").alias(TS)).distinct()
    return missing_intervals(minutes, step=MINUTE, series=REGION, chunk_rows=RAW_CHUNK)


def missing_interval_details(spark: SparkSession, sf: str) -> DataFrame:
    """The gap table that the series report writes, read back."""
    half = materialise(half_by_type(spark, sf))
    path = reports.series_report(half, series=REGION).first()["missing_interval_table"]
    return spark.read.schema(missing_intervals(half, series=REGION).schema).option("header", "true").csv(path)


def chronological_split_query(spark: SparkSession, sf: str) -> DataFrame:
    return chronological_split(half_by_type(spark, sf), series=REGION)


def expanding_folds_query(spark: SparkSession, sf: str) -> DataFrame:
    return expanding_folds(half_total(spark, sf))


def is_monotonic(spark: SparkSession, sf: str) -> DataFrame:
    return order_check(table(spark, sf, "events"), "ts", "event_id")


def sorted_output(spark: SparkSession, sf: str) -> DataFrame:
    return setops.chronological(half_by_type(spark, sf), TS, REGION)


def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Written as CSV and read back."""
    df = half_by_type(spark, sf)
    path = scratch_path(spark, "csv")
    write_csv(df, path, [SERIES, TS])
    return read_csv_like(df, path)


def top_k(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("importance")
    )
    return setops.top_k(totals, "importance", 15, "l_partkey")


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select(F.col("event_id").alias("id"), "value", "event_type")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"))
    return setops.union_by_name([ev, orders])


def missing_intervals_query(spark: SparkSession, sf: str) -> DataFrame:
    return missing_intervals(half_by_type(spark, sf), series=REGION)


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts").withColumns(calendar_columns("ts"))


def cyclical_features(spark: SparkSession, sf: str) -> DataFrame:
    dated = table(spark, sf, "events").select("event_id", "ts").withColumns(calendar_columns("ts"))
    out = dated.withColumns(cyclical_columns()).select("event_id", *cyclical_columns())
    return rounded(out, list(cyclical_columns()))


def weather_features_query(spark: SparkSession, sf: str) -> DataFrame:
    return weather_features(weather(spark, sf))


def string_normalise(spark: SparkSession, sf: str) -> DataFrame:
    name = F.lower(F.trim("c_name"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        name.alias("name"),
        name.startswith("customer").alias("has_prefix"),
        name.endswith("1").alias("has_suffix"),
        F.concat_ws("/", F.trim("c_mktsegment"), name).alias("path"),
    )


def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def upsample_linear_query(spark: SparkSession, sf: str) -> DataFrame:
    return upsample_linear(hourly(spark, sf), CONTINUOUS_WEATHER)


def expand_precipitation(spark: SparkSession, sf: str) -> DataFrame:
    return expand_backwards(hourly(spark, sf))


def clean_weather_query(spark: SparkSession, sf: str) -> DataFrame:
    return weather(spark, sf)


def clean_series(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is a correction of its half hour; the latest one stays."""
    pattern = "yyyy/MM/dd HH:mm:ss"
    slot = F.window("ts", "30 minutes").getField("start")
    raw = table(spark, sf, "events").select(
        F.col("event_type").alias(SERIES),
        F.date_format(slot, pattern).alias(TS),
        cents().cast("string").alias(TARGET),
        F.col("user_id").cast("string").alias("OPERATIONAL_DEMAND_ADJUSTMENT"),
        F.col("props").alias("WDR_ESTIMATE"),
        F.date_format("ts", pattern).alias(CHANGED),
        F.date_format("ts", "yyyy-MM-dd").alias(SOURCE_FILE),
        F.col("event_id").cast("decimal(38,0)").alias(POSITION),
    )
    return clean_demand(raw.unionByName(raw), check=False)


def _rounded_training(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if c.endswith(("_sin", "_cos")) or c.startswith("rolling_std") or c == "time_of_day"]
    return rounded(df, names, 4)


def training_table_query(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_training(training(spark, sf))


# --- learning --------------------------------------------------------------------------------------------


def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", *names)
    train = rows.filter(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    out = scale_with(rows, train, names).drop("l_shipdate")
    return rounded(out, names)


def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lagged = above_zero(add_lag_features(half_by_type(spark, sf), series=REGION).dropna())
    return rounded(metrics.evaluate_models(metrics.baseline_predictions(lagged)), ["MAE", "RMSE", "MAPE", "R2"], 4)


def _two_lags(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(scaled training part, scaled full frame, features) of a two-feature model, whose closed form SQL can state."""
    features = ["lag_1", "lag_2"]
    rows = materialise(add_lag_features(half_total(spark, sf), [1, 2]).dropna())
    labelled = materialise(chronological_split(rows))
    train = split_part(labelled, "train")
    scaler = fit_scaler(train, features)
    return scaler.transform(train), scaler.transform(labelled), features


def linear_regression(spark: SparkSession, sf: str) -> DataFrame:
    train, rows, features = _two_lags(spark, sf)
    return rounded(predict(fit_linear(train, features, TARGET), rows, [TS], TARGET), ["predicted"], 2)


def ridge_regression(spark: SparkSession, sf: str) -> DataFrame:
    train, rows, features = _two_lags(spark, sf)
    return rounded(predict(fit_ridge(train, features, TARGET), rows, [TS], TARGET), ["predicted"], 2)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return split_table(above_zero(training(spark, sf)))


def _normal_equations(spark: SparkSession, sf: str, alpha: float) -> DataFrame:
    """A fit on all features leaves, for each feature, sum(x * residual) = alpha * weight over the training rows.

    Returns the largest deviation per feature, relative to the sum of |x * residual| and rounded, which is 0 for a solution.
    """
    train, features = _train_features(_labelled(spark, sf))
    scaled = fit_scaler(train, features).transform(train)
    model = fit_linear(scaled, features, TARGET) if alpha == 0 else fit_ridge(scaled, features, TARGET, alpha)
    weights = [float(w) for w in model.stages[-1].coefficients]
    rows = model.transform(scaled)
    residual = F.col(TARGET) - F.col("prediction")
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.struct(F.lit(c).alias("feature"), F.sum(F.col(c) * residual).alias("s"), F.sum(F.abs(F.col(c) * residual)).alias("a"), F.lit(w).alias("w")).alias(f"f{i}") for i, (c, w) in enumerate(zip(features, weights))],
    )
    long = sums.select("n", F.inline(F.array(*[f"f{i}" for i in range(len(features))])))
    off = F.abs(F.col("s") - alpha * F.col("w")) / F.greatest(F.col("a"), F.lit(1.0))
    return long.select("feature", F.col("n").alias("train_rows"), F.round(off, 4).alias("deviation"))


def linear_regression_all(spark: SparkSession, sf: str) -> DataFrame:
    return _normal_equations(spark, sf, 0.0)


def ridge_regression_all(spark: SparkSession, sf: str) -> DataFrame:
    return _normal_equations(spark, sf, 1.0)


def _train_features(labelled: DataFrame) -> tuple[DataFrame, list[str]]:
    train = split_part(labelled, "train")
    return train, col_ops.feature_columns(train)


def _stated(predictions: DataFrame, train: DataFrame, reach: float) -> DataFrame:
    """Keys, actual values and whether the prediction is finite and inside the training range widened by ``reach`` times it."""
    lo, hi = (float(x) for x in train.agg(F.min(TARGET), F.max(TARGET)).first())
    p, room = F.col("predicted"), reach * (hi - lo)
    return predictions.withColumn("plausible", F.coalesce(p.isNotNull() & ~F.isnan(p) & p.between(lo - room, hi + room), F.lit(False))).drop("predicted", "residual")


def _stated_importance(importances: DataFrame, features: list[str]) -> DataFrame:
    """Every feature of the model, its importance being a share: none below 0, the sum 1."""
    total = importances.agg(F.round(F.sum("importance"), 6)).first()[0]
    named = train_names(importances.sparkSession, features).join(importances, "feature", "left")
    return named.select("feature", (F.coalesce("importance", F.lit(0.0)) >= 0).alias("valid"), F.lit(total).alias("total"))


def train_names(spark: SparkSession, features: list[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in features], "feature string")


def random_forest(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    train, features = _train_features(labelled)
    model = fit_random_forest(train, features, TARGET)
    return _stated(predict(model, split_part(labelled, "validation"), [TS], TARGET), train, 0.0)


def rf_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, features = _train_features(_labelled(spark, sf))
    return _stated_importance(importance_table(fit_random_forest(train, features, TARGET), train), features)


def gbt_default(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    train, features = _train_features(labelled)
    model = fit_boosted_default(train, features, TARGET)
    return _stated(predict(model, split_part(labelled, "validation"), [TS], TARGET), train, 1.0)


def gbt_custom(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    train, features = _train_features(labelled)
    model = fit_boosted(train, features, TARGET)
    return _stated(predict(model, split_part(labelled, "validation"), [TS], TARGET), train, 1.0)


def gbt_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, features = _train_features(_labelled(spark, sf))
    return _stated_importance(importance_table(fit_boosted_default(train, features, TARGET), train), features)


def gbt_tuned(spark: SparkSession, sf: str) -> DataFrame:
    train, features = _train_features(_labelled(spark, sf))
    found = tune_boosted(train, features, n_iter=BUDGET.search_iterations, space=BUDGET.search_space).results
    errors = ("mean_validation_MAE", "std_validation_MAE", "mean_training_MAE", "mean_fit_time")
    valid = reduce(and_, [F.col(c) >= 0 for c in errors])
    return found.select(F.col("rank_test_score").cast("int").alias("rank_test_score"), valid.alias("valid"))


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """All candidates at full size; the metrics of the three naive ones are exact on both engines."""
    found = fit_candidates(_labelled(spark, sf)).comparison
    names = ["MAE", "RMSE", "MAPE", "R2"]
    naive = F.col("model").startswith("previous_")
    finite = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in names])
    return rounded(found, names, 4).select("model", finite.alias("finite"), *[F.when(naive, F.col(c)).alias(c) for c in names])


def final_forecast_query(spark: SparkSession, sf: str) -> DataFrame:
    """The better of the boosted candidates on validation, refitted and applied to the test part."""
    labelled = _labelled(spark, sf)
    train, features = _train_features(labelled)
    search = tune_boosted(train, features, n_iter=BUDGET.search_iterations, space=BUDGET.search_space)
    scored = split_part(labelled, "validation").select(F.col(TARGET).alias("actual"), *features)
    for name, model in zip(BOOSTED, (fit_boosted_default(train, features, TARGET), search.model)):
        scored = model.transform(scored).drop("features").withColumnRenamed("prediction", name)
    comparison = metrics.evaluate_models(scored.select("actual", *BOOSTED))
    selected = metrics.select_best(comparison, BOOSTED).first()["model"]
    parameters = search.best_parameters if selected == "tuned_boosted" else None
    result = final_forecast(labelled, selected, parameters, max_bins=BUDGET.max_bins)
    return _stated(result.predictions, split_part(labelled, "train", "validation"), 1.0)


# --- reports -------------------------------------------------------------------------------------------


def timestamp_profile(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return profiles.timestamp_profile(ev, "ts", ordinal="event_id").drop("most_common_intervals")


def series_report(spark: SparkSession, sf: str) -> DataFrame:
    out = reports.series_report(half_by_type(spark, sf), series=REGION)
    return out.select("rows", "start_datetime", "end_datetime", "duplicate_intervals", "missing_interval_count")


def demand_report(spark: SparkSession, sf: str) -> DataFrame:
    out = reports.demand_report(half_total(spark, sf))
    return out.select(
        "row_count",
        "column_count",
        "timestamp.invalid_timestamp_count",
        "timestamp.duplicate_timestamp_count",
        "timestamp.is_monotonic_increasing",
        "timestamp.minimum_timestamp",
        "timestamp.maximum_timestamp",
        "target.*",
        "status",
    )


def _slot_number() -> Column:
    return F.floor(micros(TS) / HALF_HOUR)


def demand_report_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Planted faults: missing and infinite values, missing and repeated timestamps, rows ingested out of order."""
    k = F.col("k")
    rows = half_total(spark, sf).withColumn("k", _slot_number())
    value = F.when(k % 7 == 0, None).when(k % 11 == 0, F.lit(float("inf"))).otherwise(F.col(TARGET).cast("double"))
    stamp = F.when(k % 13 == 0, None).when(k % 17 == 0, shift(TS, -HALF_HOUR)).otherwise(F.col(TS))
    dirty = rows.select(stamp.alias(TS), value.alias(TARGET), (k * 7919 % 1000003).alias("place"))
    out = reports.demand_report(materialise(dirty), ordinal="place")
    counters = ["invalid_timestamp_count", "duplicate_timestamp_count", "is_monotonic_increasing"]
    values = ["missing_or_non_numeric_count", "infinite_count", "non_positive_count", "minimum"]
    return out.select("row_count", *[f"timestamp.{c}" for c in counters], *[f"target.{c}" for c in values], F.size("failures").alias("faults"), "status")


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    k = _slot_number()
    rows = half_total(spark, sf)
    return materialise(rows.select(F.when(k % 13 != 0, F.col(TS)).alias(TS), F.when(k % 7 != 0, F.col(TARGET).cast("double")).alias(TARGET)))


def _told(action: Callable[[], object]) -> str | None:
    try:
        action()
    except (GuardError, DataQualityError, ValueError) as problem:
        return str(problem)
    return None


def fault_messages(spark: SparkSession, sf: str) -> DataFrame:
    """What guards and a failing report say about planted faults; a refused report is saved all the same, and nothing is published."""
    ev, half, total, dirty = table(spark, sf, "events"), materialise(half_by_type(spark, sf)), half_total(spark, sf), _dirty(spark, sf)
    run = RunFolder(spark, scratch_path(spark, "refused"))
    saved = run.path("verification/demand.json")
    lagged = materialise(add_lag_features(total, [336]))
    told = {
        "absent_columns": _told(lambda: col_ops.require_columns(ev, ["ts", "absent"], "events")),
        "missing_values": _told(lambda: col_ops.require_no_missing(dirty, [TS, TARGET], "demand")),
        "repeated_keys": _told(lambda: joins.require_unique(ev, ["user_id", "event_type"], "events")),
        "no_rows": _told(lambda: col_ops.require_rows(ev.filter("event_id < 0"), "events")),
        "right_side": _told(lambda: joins.join_one_to_one(total, half, [TS])),
        "unknown_series": _told(lambda: col_ops.filter_series(half, "absent", require_match=True)),
        "fit_gaps": _told(lambda: check_fit_input(lagged, ["lag_336"], TARGET)),
        "fit_text": _told(lambda: check_fit_input(ev, ["event_type"], "value")),
        "uneven_steps": _told(lambda: require_continuous(half, TS, HALF_HOUR, REGION)),
        "failing_report": _told(lambda: reports.enforce(reports.demand_report(dirty), saved)),
        "published": str(path_exists(spark, f"{run.output}/{MANIFEST}")),
    }
    report = read_json_report(spark, saved, "row_count long, status string")
    kept = report.select(F.lit("saved_report").alias("fault"), F.concat_ws(" ", "status", "row_count").alias("message"))
    return spark.createDataFrame(list(told.items()), "fault string, message string").unionByName(kept)


def weather_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that accepted requests read, and what refused ones are told."""
    path = _payload_path(spark, sf)
    wanted = {
        "all": {},
        "place": {"latitude": 10.0},
        "nowhere": {"latitude": -90.0, "longitude": 180.0},
        "north": {"latitude": 90.5},
        "west": {"longitude": -181.0},
        "order": {"start": "2024-01-02", "end": "2024-01-01"},
        "nothing": {"variables": []},
    }

    def answer(name: str, options: dict) -> DataFrame:
        message = _told(lambda: read_columnar_json(spark, path, multi_line=False, **options))
        rows = spark.range(0) if message else read_columnar_json(spark, path, multi_line=False, **options)[0]
        return rows.agg(F.lit(name).alias("request"), F.count(F.lit(1)).alias("n_rows"), F.lit(message).cast("string").alias("message"))

    return reduce(DataFrame.unionByName, [answer(k, v) for k, v in wanted.items()])


def strict_types(spark: SparkSession, sf: str) -> DataFrame:
    """Strict casts of well-formed text, ISO text of timestamps, and NaN as null."""
    orders = table(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit("NaN")).otherwise(F.col("o_totalprice").cast("string"))
    text = orders.select("o_orderkey", F.col("o_orderdate").cast("string").alias("stamp"), price.alias("price"))
    typed = text.select("o_orderkey", strict_timestamp("stamp").alias("stamp"), strict_double("price").alias("price"))
    return typed.select("o_orderkey", "stamp", F.date_format("stamp", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), "price")


def published_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Detail tables, report, training table and model of a run: written, published, and read back through the manifest."""
    output = scratch_path(spark, "outputs")
    run = RunFolder(spark, output)
    with scratch_scope(spark) as scratch:
        demand, companion = materialise(half_total(spark, sf)), materialise(weather(spark, sf).filter(F.hour(TS) != 3))
        merged = materialise(joins.attach_weather(demand, companion))
        write_merge_details(demand, companion, merged, run.path("details"))
        reports.enforce(reports.demand_report(demand), run.path("verification/demand.json"))
        rows = materialise(training(spark, sf))
        write_training_table(rows, run.root)
        model = fit_linear(rows, ["lag_1", "lag_48"], TARGET)
        save_model(model, run.path("models/linear"))
        write_parquet(predict(model, rows, [TS], TARGET), run.path("predictions"))
        run.publish({"rows": rows.count()})
    found = published(spark, output)
    root = found["folder"]
    csv = spark.read.option("header", True)
    details = ["unmatched_demand_timestamps", "extra_weather_timestamps", "merged_rows_with_missing_weather"]
    tables = {name: csv.csv(f"{root}/details/{name}").select(TS) for name in details}
    again = spark.read.parquet(f"{root}/training_dataset.parquet")
    scored = predict(load_model(f"{root}/models/linear"), again, [TS], TARGET, "again").join(spark.read.parquet(f"{root}/predictions").select(TS, "predicted"), TS)
    tables |= {"training_parquet": again, "training_csv": csv.csv(f"{root}/training_dataset.csv"), "same_predictions": scored.filter("abs(again - predicted) < 1e-6")}
    first = F.min(F.col(TS).cast("timestamp_ntz")).alias("first")
    counted = [df.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n_rows"), first) for name, df in tables.items()]
    report = read_json_report(spark, f"{root}/verification/demand.json", "row_count long, timestamp struct<minimum_timestamp:string>")
    stamp = F.col("timestamp.minimum_timestamp").cast("timestamp_ntz").alias("first")
    counted.append(report.select(F.lit("report").alias("output"), F.col("row_count").alias("n_rows"), stamp))
    told = -1 if path_exists(spark, scratch) else found["summary"]["rows"]
    counted.append(spark.range(1).select(F.lit("manifest").alias("output"), F.lit(told).cast("long").alias("n_rows"), F.lit(None).cast("timestamp_ntz").alias("first")))
    return reduce(DataFrame.unionByName, counted)


def training_report_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Planted faults: a missing lag, an infinite temperature, rows in the wrong order."""
    k = F.col("place")
    rows = training(spark, sf).withColumn("place", -_slot_number())
    lag, heat = F.when(k % 5 != 0, F.col("lag_1")), F.when(k % 9 == 0, F.lit(float("inf"))).otherwise(F.col("temperature"))
    out = reports.training_report(materialise(rows.withColumns({"lag_1": lag, "temperature": heat})), ordinal="place")
    return out.select(
        "row_count",
        "feature_count",
        "missing_value_count",
        F.coalesce(F.try_element_at("missing_values_by_column", F.lit("lag_1")), F.lit(0).cast("long")).alias("missing_lags"),
        F.coalesce(F.try_element_at("infinite_values_by_column", F.lit("temperature")), F.lit(0).cast("long")).alias("infinite_temperatures"),
        "timestamp.is_monotonic_increasing",
        F.size("failures").alias("faults"),
        "status",
    )


def weather_report(spark: SparkSession, sf: str) -> DataFrame:
    out = reports.weather_report(materialise(weather_features(weather(spark, sf))))
    return out.select(
        "row_count",
        "column_count",
        "weather_feature_count",
        "missing_value_count",
        F.col("missing_values_by_column")["temperature_change_1h"].alias("missing_change_1h"),
        F.col("missing_values_by_column")["temperature_change_3h"].alias("missing_change_3h"),
        F.size("infinite_values_by_column").alias("infinite_columns"),
        "timestamp.duplicate_timestamp_count",
        "status",
    )


def training_report(spark: SparkSession, sf: str) -> DataFrame:
    out = reports.training_report(materialise(training(spark, sf)))
    return out.select(
        "row_count",
        "column_count",
        "feature_count",
        "target_in_features",
        "timestamp_in_features",
        F.size("non_numeric_features").alias("non_numeric_count"),
        "missing_value_count",
        "timestamp.duplicate_timestamp_count",
        "timestamp.is_monotonic_increasing",
        "timestamp.minimum_timestamp",
        "timestamp.maximum_timestamp",
        "status",
    )


def split_report(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    parts = [split_part(labelled, p) for p in ("train", "validation", "test")]
    return _split_columns(reports.split_report(labelled.drop("split"), *parts, features=_train_features(labelled)[1]))


def split_report_by_series(spark: SparkSession, sf: str) -> DataFrame:
    full = add_lag_features(half_by_type(spark, sf), [1, 2], series=REGION).dropna()
    labelled = materialise(chronological_split(materialise(full), series=REGION))
    parts = [split_part(labelled, p) for p in ("train", "validation", "test")]
    return _split_columns(reports.split_report(full, *parts, features=["lag_1", "lag_2", "lag_9"], keys=REGION))


def _split_columns(out: DataFrame) -> DataFrame:
    return out.select(
        "full_row_count",
        "train_row_count",
        "validation_row_count",
        "test_row_count",
        "feature_count",
        F.size("missing_feature_columns").alias("missing_features"),
        "row_total_matches_full_dataset",
        "timestamp_overlap_counts.*",
        "train_before_validation",
        "validation_before_test",
        "boundaries.*",
        "status",
    )


def model_output_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = _baseline_rows(spark, sf)
    comparison = metrics.evaluate_models(rows)
    predictions = col_ops.with_residual(rows.select("actual", F.col("previous_interval").alias("predicted")))
    out = reports.model_output_report(
        comparison, predictions, metrics.regression_metrics(predictions), "previous_interval"
    )
    return out.select(
        "selected_model",
        "selected_model_present_in_comparison",
        "comparison_row_count",
        "test_prediction_row_count",
        "test_prediction_missing_value_count",
        F.size("non_finite_prediction_counts").alias("non_finite_columns"),
        "status",
    )


QUERIES: dict[str, Query] = {
    "ingest_tagged_csv": ingest_tagged_csv,
    "ingest_quoted_breaks": ingest_quoted_breaks,
    "ingest_nested_zip": ingest_nested_zip,
    "ingest_summary": ingest_summary_query,
    "ingest_columnar_json": ingest_columnar_json,
    "weather_metadata": weather_metadata,
    "project_model_columns": project_model_columns,
    "coerce_types": coerce_types,
    "residuals": residuals,
    "metric_improvement": metric_improvement,
    "filter_series": filter_series,
    "drop_warmup": drop_warmup,
    "rows_with_missing": rows_with_missing,
    "all_null_rows": all_null_rows,
    "upsert_by_key": upsert_by_key,
    "null_counts": null_counts,
    "join_left_one_to_one": join_left_one_to_one,
    "join_inner_one_to_one": join_inner_one_to_one,
    "unmatched_keys": unmatched_keys,
    "extra_keys": extra_keys,
    "match_rate": match_rate,
    "merge_report": merge_report,
    "split_overlap": split_overlap,
    "table_profile": table_profile,
    "target_profile": target_profile,
    "infinite_counts": infinite_counts,
    "duplicate_count": duplicate_count,
    "distinct_series": distinct_series,
    "value_counts": value_counts,
    "dedup_exact": dedup_exact,
    "dedup_latest": dedup_latest,
    "regression_metrics": regression_metrics,
    "evaluate_models": evaluate_models,
    "cv_summary": cv_summary,
    "select_best": select_best,
    "lag_features": lag_features,
    "lag_features_raw": lag_features_raw,
    "lag_by_time": lag_by_time,
    "lag_far": lag_far,
    "rolling_features": rolling_features,
    "rolling_features_raw": rolling_features_raw,
    "diff_features": diff_features,
    "interval_continuity": interval_continuity,
    "chronological_split": chronological_split_query,
    "chronological_split_raw": chronological_split_raw,
    "expanding_folds": expanding_folds_query,
    "is_monotonic": is_monotonic,
    "sorted_output": sorted_output,
    "sink_csv": sink_csv,
    "top_k": top_k,
    "union_by_name": union_by_name,
    "missing_intervals": missing_intervals_query,
    "missing_interval_details": missing_interval_details,
    "missing_intervals_raw": missing_intervals_raw,
    "calendar_features": calendar_features,
    "cyclical_features": cyclical_features,
    "weather_features": weather_features_query,
    "string_normalise": string_normalise,
    "json_extract": json_extract,
    "upsample_linear": upsample_linear_query,
    "expand_precipitation": expand_precipitation,
    "clean_weather": clean_weather_query,
    "clean_series": clean_series,
    "training_table": training_table_query,
    "standard_scale": standard_scale,
    "baseline_metrics": baseline_metrics,
    "linear_regression": linear_regression,
    "linear_regression_all": linear_regression_all,
    "ridge_regression": ridge_regression,
    "ridge_regression_all": ridge_regression_all,
    "random_forest": random_forest,
    "rf_importance": rf_importance,
    "gbt_default": gbt_default,
    "gbt_custom": gbt_custom,
    "gbt_importance": gbt_importance,
    "gbt_tuned": gbt_tuned,
    "model_comparison": model_comparison,
    "final_forecast": final_forecast_query,
    "timestamp_profile": timestamp_profile,
    "series_report": series_report,
    "demand_report": demand_report,
    "demand_report_dirty": demand_report_dirty,
    "weather_report": weather_report,
    "training_report": training_report,
    "training_report_dirty": training_report_dirty,
    "fault_messages": fault_messages,
    "weather_requests": weather_requests,
    "strict_types": strict_types,
    "published_outputs": published_outputs,
    "split_report": split_report,
    "split_report_by_series": split_report_by_series,
    "model_output_report": model_output_report,
}
