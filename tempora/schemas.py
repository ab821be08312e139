"""Column names, schemas and defaults shared by the whole library."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names and defaults that results must agree on -------------------------------

TS = "INTERVAL_DATETIME"
TARGET = "OPERATIONAL_DEMAND"
SERIES = "REGIONID"
CHANGED = "LASTCHANGED"
SOURCE_FILE = "SOURCE_FILE"

RECORD_COLUMNS = ["RECORD_TYPE", "DATASET", "DATA_TYPE", "VERSION"]
DEMAND_NUMERIC_COLUMNS = ["OPERATIONAL_DEMAND", "OPERATIONAL_DEMAND_ADJUSTMENT", "WDR_ESTIMATE"]
TIMESTAMP_PATTERN = "y/M/d H:m:s"

HOURLY_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "apparent_temperature",
    "precipitation",
    "cloud_cover",
    "wind_speed_10m",
    "shortwave_radiation_instant",
]
WEATHER_RENAMES = {
    "time": "INTERVAL_DATETIME",
    "temperature_2m": "temperature",
    "relative_humidity_2m": "relative_humidity",
    "wind_speed_10m": "wind_speed",
    "shortwave_radiation_instant": "solar_radiation",
}
CONTINUOUS_WEATHER = [
    "temperature",
    "relative_humidity",
    "apparent_temperature",
    "cloud_cover",
    "wind_speed",
    "solar_radiation",
]
WEATHER_COLUMNS = CONTINUOUS_WEATHER + ["precipitation", "is_raining"]
DERIVED_WEATHER_COLUMNS = [
    "heating_degree",
    "cooling_degree",
    "temperature_squared",
    "apparent_temperature_difference",
    "temperature_change_1h",
    "temperature_change_3h",
    "temperature_humidity_interaction",
    "is_high_temperature",
    "is_high_humidity",
    "is_hot_and_humid",
    "is_daylight",
    "is_moderate_rain",
    "is_heavy_rain",
]

LAGS = [1, 2, 48, 336]
ROLLING_WINDOWS = [4, 48]
BASELINES = {"previous_interval": "lag_1", "previous_day": "lag_48", "previous_week": "lag_336"}
TRAIN_RATIO = 0.70
VALIDATION_RATIO = 0.15
MINIMUM_MATCH_RATE = 0.99
SEED = 42
COMPARISON_COLUMNS = ["model", "MAE", "RMSE", "MAPE", "R2"]

# Search space of the boosted trees.
SEARCH_SPACE = {
    "n_estimators": [300, 500, 700, 900, 1200],
    "learning_rate": [0.01, 0.025, 0.05, 0.075, 0.1],
    "max_depth": [3, 4, 5, 6, 7, 8],
    "min_child_weight": [1, 3, 5, 7, 10],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
}

# --- end of fixed values -----------------------------------------------------------------------


def columnar_schema(variables: list[str]) -> T.StructType:
    """Payload schema of a columnar JSON document: parallel arrays below ``hourly``."""
    hourly = [T.StructField("time", T.ArrayType(T.StringType()))]
    hourly += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType(
        [
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("elevation", T.DoubleType()),
            T.StructField("timezone", T.StringType()),
            T.StructField("timezone_abbreviation", T.StringType()),
            T.StructField("utc_offset_seconds", T.IntegerType()),
            T.StructField("hourly_units", T.MapType(T.StringType(), T.StringType())),
            T.StructField("hourly", T.StructType(hourly)),
            T.StructField("error", T.BooleanType()),
            T.StructField("reason", T.StringType()),
        ]
    )
