"""SQL statements that compute the registered queries independently, from the same tables."""

from __future__ import annotations

from tempora.schemas import WEATHER_COLUMNS

CENTS = "CAST(round(value * 100) AS BIGINT)"



def fixed(value: str, digits: int) -> str:
    """Fixed number of decimals by plain arithmetic."""
    scale = f"1e{digits}::DOUBLE"
    return f"floor(({value}) * {scale} + 0.5::DOUBLE) / {scale}"


# --- derived inputs as common table expressions -------------------------------------------------

HALF_TYPE = f"""
half_t AS (
  SELECT event_type AS "REGIONID", time_bucket(INTERVAL '30 minutes', ts) AS "INTERVAL_DATETIME",
         CAST(sum({CENTS}) AS BIGINT) AS "OPERATIONAL_DEMAND"
  FROM events GROUP BY 1, 2)"""

HALF = f"""
half AS (
  SELECT time_bucket(INTERVAL '30 minutes', ts) AS "INTERVAL_DATETIME",
         CAST(sum({CENTS}) AS BIGINT) AS "OPERATIONAL_DEMAND"
  FROM events GROUP BY 1)"""

HOURLY = f"""
hours AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS t, count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS s,
         min({CENTS}) AS lo, max({CENTS}) AS hi
  FROM events GROUP BY 1),
hourly AS (
  SELECT t AS "INTERVAL_DATETIME",
         CAST(s % 4500 AS DOUBLE) / 100.0::DOUBLE AS temperature,
         CAST(hi % 10000 AS DOUBLE) / 100.0::DOUBLE AS relative_humidity,
         CAST(lo % 4500 AS DOUBLE) / 100.0::DOUBLE AS apparent_temperature,
         CAST(n % 100 AS DOUBLE) AS cloud_cover,
         CAST(s % 700 AS DOUBLE) / 10.0::DOUBLE AS wind_speed,
         CAST(greatest(s % 9000 - 3000, 0) AS DOUBLE) / 10.0::DOUBLE AS solar_radiation,
         CASE WHEN n % 3 = 0 THEN CAST(hi % 800 AS DOUBLE) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS precipitation
  FROM hours)"""

_CONTINUOUS = [
    "temperature",
    "relative_humidity",
    "apparent_temperature",
    "cloud_cover",
    "wind_speed",
    "solar_radiation",
]
_LERP = ",\n         ".join(
    f"CASE WHEN k = 0 THEN {c} ELSE {c} + (n_{c} - {c}) * (CAST(k * 30 AS DOUBLE) / CAST(mins AS DOUBLE)) END AS {c}"
    for c in _CONTINUOUS
)
_NEXT = ", ".join(f"lead({c}) OVER w AS n_{c}" for c in _CONTINUOUS)

WEATHER = (
    HOURLY
    + f""",
ahead AS (
  SELECT *, lead("INTERVAL_DATETIME") OVER w AS nt, {_NEXT} FROM hourly WINDOW w AS (ORDER BY "INTERVAL_DATETIME")),
spans AS (SELECT *, coalesce(date_diff('minute', "INTERVAL_DATETIME", nt), 30) AS mins FROM ahead),
steps AS (SELECT *, unnest(range(0, mins // 30)) AS k FROM spans),
smooth AS (
  SELECT "INTERVAL_DATETIME" + k * INTERVAL '30 minutes' AS "INTERVAL_DATETIME",
         {_LERP}
  FROM steps),
rain_all AS (
  SELECT "INTERVAL_DATETIME" - INTERVAL '30 minutes' AS t, precipitation AS p, 1 AS moved FROM hourly
  UNION ALL SELECT "INTERVAL_DATETIME", precipitation, 0 FROM hourly),
rain AS (
  SELECT t AS "INTERVAL_DATETIME", p AS precipitation, CAST(p > 0 AS TINYINT) AS is_raining
  FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY moved) AS r FROM rain_all) WHERE r = 1),
weather AS (SELECT smooth.*, rain.precipitation, rain.is_raining FROM smooth JOIN rain USING ("INTERVAL_DATETIME"))"""
)

_LAGS = ", ".join(f'lag("OPERATIONAL_DEMAND", {k}) OVER w AS lag_{k}' for k in (1, 2, 48, 336))


def _rolling(digits: int | None) -> str:
    out = []
    for n in (4, 48):
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            value = f'{fn}("OPERATIONAL_DEMAND") OVER w{n}'
            if name == "std" and digits is not None:
                value = fixed(value, digits)
            out.append(f'CASE WHEN count("OPERATIONAL_DEMAND") OVER w{n} = {n} THEN {value} END AS rolling_{name}_{n}')
    return ", ".join(out)


def _windows(partition: str) -> str:
    base = f'{partition} ORDER BY "INTERVAL_DATETIME"'
    frames = ", ".join(f"w{n} AS ({base} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (4, 48))
    return f"WINDOW w AS ({base}), {frames}"


LAG_TYPE = HALF_TYPE + f""",
lagged_t AS (SELECT *, {_LAGS} FROM half_t WINDOW w AS (PARTITION BY "REGIONID" ORDER BY "INTERVAL_DATETIME"))"""
LAG = HALF + f""",
lagged AS (SELECT *, {_LAGS} FROM half WINDOW w AS (ORDER BY "INTERVAL_DATETIME"))"""

_CALENDAR = """CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month, CAST(day({t}) AS INTEGER) AS day,
  CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week, CAST(hour({t}) AS INTEGER) AS hour,
  CAST(minute({t}) AS INTEGER) AS minute, CAST(isodow({t}) >= 6 AS INTEGER) AS is_weekend"""


def calendar(t: str) -> str:
    return _CALENDAR.format(t=t)


def cyclical(t: str, digits: int) -> str:
    tod = f"(hour({t}) + minute({t}) / 60.0::DOUBLE)"
    parts = [f"{fixed(tod, digits)} AS time_of_day"]
    for name, value, period in (
        ("time", tod, 24),
        ("day_of_week", f"(isodow({t}) - 1)", 7),
        ("month", f"(month({t}) - 1)", 12),
    ):
        for fn in ("sin", "cos"):
            angle = f"{fn}({value} * (2 * pi()) / {period}.0::DOUBLE)"
            parts.append(f"{fixed(angle, digits)} AS {name}_{fn}")
    return ", ".join(parts)


_METRICS = """avg(abs(a - p)) AS "MAE", sqrt(avg((a - p) * (a - p))) AS "RMSE", avg(abs((a - p) / a)) * 100 AS "MAPE",
  1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)) AS "R2" """

BASE = LAG + """,
base AS (
  SELECT CAST("OPERATIONAL_DEMAND" + 1 AS DOUBLE) AS a, lag_1, lag_48, lag_336
  FROM lagged WHERE lag_336 IS NOT NULL),
long AS (
  SELECT 'previous_interval' AS model, a, CAST(lag_1 AS DOUBLE) AS p FROM base
  UNION ALL SELECT 'previous_day', a, CAST(lag_48 AS DOUBLE) FROM base
  UNION ALL SELECT 'previous_week', a, CAST(lag_336 AS DOUBLE) FROM base),
comparison AS (SELECT model, """ + _METRICS + """ FROM long GROUP BY model)"""


def rounded(digits: int, *names: str) -> str:
    return ", ".join(fixed(f'"{n}"', digits) + f' AS "{n}"' for n in names)


TRAIN = (
    HALF + "," + WEATHER + f""",
featured AS (
  SELECT *, {calendar('"INTERVAL_DATETIME"')}, {_LAGS}, {_rolling(4)}, {cyclical('"INTERVAL_DATETIME"', 4)}
  FROM half {_windows('')}),
training AS (
  SELECT f.*, {", ".join("w." + c for c in WEATHER_COLUMNS)}
  FROM featured f JOIN weather w USING ("INTERVAL_DATETIME")
  WHERE f.lag_336 IS NOT NULL)"""
)

STAMPS = HALF_TYPE + """,
stamps AS (SELECT DISTINCT "INTERVAL_DATETIME" FROM half_t)"""

STAMP = "strftime({}, '%Y/%m/%d %H:%M:%S')"

MISSING = HALF_TYPE + """,
edges AS (SELECT "REGIONID", min("INTERVAL_DATETIME") AS a, max("INTERVAL_DATETIME") AS b FROM half_t GROUP BY 1),
grid AS (
  SELECT "REGIONID", unnest(generate_series(a, b, INTERVAL '30 minutes')) AS "INTERVAL_DATETIME" FROM edges),
missing AS (SELECT * FROM grid EXCEPT SELECT "REGIONID", "INTERVAL_DATETIME" FROM half_t)"""

STEPS = HALF_TYPE + """,
steps_t AS (
  SELECT date_diff('microsecond', lag("INTERVAL_DATETIME") OVER (PARTITION BY "REGIONID" ORDER BY "INTERVAL_DATETIME"),
                   "INTERVAL_DATETIME") AS us FROM half_t)"""


def split_cte(source: str, partition: str) -> str:
    return f"""
numbered AS (
  SELECT *, row_number() OVER ({partition} ORDER BY "INTERVAL_DATETIME") - 1 AS i, count(*) OVER ({partition}) AS n
  FROM {source}),
labelled AS (
  SELECT *, CASE WHEN i < floor(n * CAST(0.70 AS DOUBLE)) THEN 'train'
                 WHEN i < floor(n * CAST(0.70 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'validation'
                 ELSE 'test' END AS split
  FROM numbered)"""


def two_feature_fit(alpha: float) -> str:
    """Closed form of a two-feature (ridge) regression on features standardised on the training part."""
    return f"""
WITH {HALF},
two AS (
  SELECT *, lag("OPERATIONAL_DEMAND", 1) OVER w AS lag_1, lag("OPERATIONAL_DEMAND", 2) OVER w AS lag_2
  FROM half WINDOW w AS (ORDER BY "INTERVAL_DATETIME")),
complete AS (SELECT * FROM two WHERE lag_2 IS NOT NULL),
{split_cte("complete", "")},
st AS (
  SELECT count(*) AS n, avg(lag_1) AS m1, avg(lag_2) AS m2, stddev_pop(lag_1) AS s1, stddev_pop(lag_2) AS s2,
         avg("OPERATIONAL_DEMAND") AS my, covar_pop(lag_1, lag_2) AS c12,
         covar_pop(lag_1, "OPERATIONAL_DEMAND") AS c1y, covar_pop(lag_2, "OPERATIONAL_DEMAND") AS c2y
  FROM labelled WHERE split = 'train'),
z AS (SELECT *, n + {alpha}::DOUBLE AS d, n * c12 / (s1 * s2) AS o, n * c1y / s1 AS b1, n * c2y / s2 AS b2 FROM st),
w AS (SELECT *, (d * b1 - o * b2) / (d * d - o * o) AS w1, (d * b2 - o * b1) / (d * d - o * o) AS w2 FROM z)
SELECT "INTERVAL_DATETIME", CAST("OPERATIONAL_DEMAND" AS DOUBLE) AS actual,
       {fixed("my + w1 * (lag_1 - m1) / s1 + w2 * (lag_2 - m2) / s2", 2)} AS predicted
FROM labelled CROSS JOIN w"""


_DERIVED = """greatest(18.0::DOUBLE - temperature, 0) AS heating_degree,
  greatest(temperature - 22.0::DOUBLE, 0) AS cooling_degree,
  temperature * temperature AS temperature_squared,
  apparent_temperature - temperature AS apparent_temperature_difference,
  temperature - lag(temperature, 2) OVER w AS temperature_change_1h,
  temperature - lag(temperature, 6) OVER w AS temperature_change_3h,
  temperature * relative_humidity AS temperature_humidity_interaction,
  CAST(temperature >= 30 AS TINYINT) AS is_high_temperature,
  CAST(relative_humidity >= 80 AS TINYINT) AS is_high_humidity,
  CAST(temperature >= 30 AND relative_humidity >= 80 AS TINYINT) AS is_hot_and_humid,
  CAST(solar_radiation > 0 AS TINYINT) AS is_daylight,
  CAST(precipitation >= 1 AS TINYINT) AS is_moderate_rain,
  CAST(precipitation >= 5 AS TINYINT) AS is_heavy_rain"""

_RAW_NAMES = """"INTERVAL_DATETIME" AS time, temperature AS temperature_2m, relative_humidity AS relative_humidity_2m,
  apparent_temperature, precipitation, cloud_cover, wind_speed AS wind_speed_10m,
  solar_radiation AS shortwave_radiation_instant"""

_JOINED = f"""WITH {HALF_TYPE},{HOURLY},
joined AS (SELECT h.*, w.temperature FROM half_t h LEFT JOIN hourly w USING ("INTERVAL_DATETIME"))"""

RAW = f"""
half_t AS (
  SELECT event_type AS "REGIONID", ts AS "INTERVAL_DATETIME", CAST(sum({CENTS}) AS BIGINT) AS "OPERATIONAL_DEMAND"
  FROM events GROUP BY 1, 2)"""

# The features of the training table.
_NAMES = (
    ["year", "month", "day", "day_of_week", "hour", "minute", "is_weekend"]
    + [f"lag_{k}" for k in (1, 2, 48, 336)]
    + [f"rolling_{f}_{n}" for n in (4, 48) for f in ("mean", "std", "min", "max")]
    + ["time_of_day", "time_sin", "time_cos", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos"]
    + list(WEATHER_COLUMNS)
)
_IMPORTANCE = f"SELECT unnest({_NAMES!r}) AS feature, true AS valid, 1.0::DOUBLE AS total"
_NORMAL = f"""WITH {TRAIN},{split_cte("training", "")}
SELECT unnest({_NAMES!r}) AS feature, count(*) FILTER (split = 'train') AS train_rows, 0.0::DOUBLE AS deviation FROM labelled"""


def _stated(part: str) -> str:
    """Keys and actual values of one part, every prediction being plausible."""
    return f"""WITH {TRAIN},{split_cte("training", "")}
SELECT "INTERVAL_DATETIME", CAST("OPERATIONAL_DEMAND" + 1 AS DOUBLE) AS actual, true AS plausible FROM labelled WHERE split = '{part}'"""


def _split_report(ctes: str, features: int, absent: int, series: str) -> str:
    """Counts, overlaps and order of the parts inside each series, and what follows for the status."""
    parts = ("train", "validation", "test")
    edges = ", ".join(
        f'{fn}("INTERVAL_DATETIME") FILTER (split = ' + f"'{p}') AS {p}_{edge}" for p in parts for fn, edge in (("min", "start"), ("max", "end"))
    )
    return f"""{ctes},
k AS (SELECT {series}"INTERVAL_DATETIME", bool_or(split = 'train') AS a, bool_or(split = 'validation') AS b, bool_or(split = 'test') AS c
      FROM labelled GROUP BY ALL),
o AS (SELECT count(*) FILTER (a AND b) AS train_validation, count(*) FILTER (a AND c) AS train_test,
             count(*) FILTER (b AND c) AS validation_test FROM k),
e AS (SELECT {series}{edges} FROM labelled GROUP BY {series.rstrip(", ") or "()"}),
w AS (SELECT bool_and(train_end < validation_start) AS first, bool_and(validation_end < test_start) AS second FROM e),
n AS (SELECT count(*) AS full_row_count, count(*) FILTER (split = 'train') AS train_row_count,
             count(*) FILTER (split = 'validation') AS validation_row_count, count(*) FILTER (split = 'test') AS test_row_count,
             {edges} FROM labelled)
SELECT full_row_count, train_row_count, validation_row_count, test_row_count, CAST({features} AS INTEGER) AS feature_count,
       CAST({absent} AS INTEGER) AS missing_features,
       train_row_count + validation_row_count + test_row_count = full_row_count AS row_total_matches_full_dataset,
       train_validation, train_test, validation_test, coalesce(first, false) AS train_before_validation,
       coalesce(second, false) AS validation_before_test, {", ".join(f"{p}_{x}" for p in parts for x in ("start", "end"))},
       CASE WHEN {absent} > 0 OR train_validation + train_test + validation_test > 0 OR NOT coalesce(first AND second, false)
              OR least(train_row_count, validation_row_count, test_row_count) = 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM n, o, w"""


ORACLES: dict[str, str] = {
    "ingest_tagged_csv": f"""WITH {HALF_TYPE}
SELECT 'D' AS "RECORD_TYPE", '3' AS "VERSION", "REGIONID",
       {STAMP.format('"INTERVAL_DATETIME"')} AS "INTERVAL_DATETIME",
       CAST("OPERATIONAL_DEMAND" AS VARCHAR) AS "OPERATIONAL_DEMAND",
       {STAMP.format('"INTERVAL_DATETIME"')} AS "LASTCHANGED" FROM half_t""",
    "ingest_quoted_breaks": """SELECT CAST(event_id AS VARCHAR) AS "ID", CASE WHEN event_id % 3 = 0
       THEN event_type || chr(10) || 'D,x,"quoted" ' || event_id || chr(10) ELSE event_type END AS "NOTE", 'z' AS "END" FROM events""",
    "ingest_nested_zip": f"""WITH {HALF_TYPE}
SELECT "REGIONID", "INTERVAL_DATETIME", CAST("OPERATIONAL_DEMAND" AS DOUBLE) AS "OPERATIONAL_DEMAND",
       "INTERVAL_DATETIME" AS "LASTCHANGED",
       strftime("INTERVAL_DATETIME", '%Y-%m.zip/%Y-%m-%d.zip/%Y-%m-%d.CSV') AS "SOURCE_FILE" FROM half_t""",
    "ingest_summary": f"""WITH {HALF_TYPE}
SELECT count(DISTINCT strftime("INTERVAL_DATETIME", '%Y-%m')) AS archives,
       count(DISTINCT CAST("INTERVAL_DATETIME" AS DATE)) AS nested_archives,
       count(DISTINCT CAST("INTERVAL_DATETIME" AS DATE)) AS files, count(*) AS data_rows FROM half_t""",
    "ingest_columnar_json": f"WITH {HOURLY} SELECT {_RAW_NAMES} FROM hourly",
    "weather_metadata": """SELECT CAST(day(d) AS DOUBLE) AS latitude, CAST(month(d) AS DOUBLE) AS longitude,
  0.0::DOUBLE AS elevation, 'UTC+10' AS timezone, 'AEST' AS timezone_abbreviation,
  CAST(36000 AS INTEGER) AS utc_offset_seconds, '°C' AS temperature_unit
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)""",
    "project_model_columns": f'WITH {HALF_TYPE} SELECT "REGIONID", "INTERVAL_DATETIME", "OPERATIONAL_DEMAND" FROM half_t',
    "coerce_types": """SELECT o_orderkey,
  CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_orderdate END AS "INTERVAL_DATETIME",
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS "LASTCHANGED",
  TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS DOUBLE)
    AS "OPERATIONAL_DEMAND" FROM orders""",
    "residuals": f"""WITH {LAG_TYPE}
SELECT "REGIONID", "INTERVAL_DATETIME", "OPERATIONAL_DEMAND" AS actual, lag_1 AS predicted,
       "OPERATIONAL_DEMAND" - lag_1 AS residual FROM lagged_t WHERE lag_1 IS NOT NULL""",
    "metric_improvement": f"""WITH {BASE}
SELECT model, {rounded(4, "MAE")},
       {fixed("(SELECT comparison.\"MAE\" FROM comparison WHERE model = 'previous_week') - comparison.\"MAE\"", 4)} AS "MAE_improvement"
FROM comparison""",
    "filter_series": f"WITH {HALF_TYPE} SELECT * FROM half_t WHERE \"REGIONID\" = 'click'",
    "drop_warmup": f"WITH {LAG_TYPE} SELECT * FROM lagged_t WHERE lag_336 IS NOT NULL",
    "rows_with_missing": _JOINED
    + ' SELECT "REGIONID", "INTERVAL_DATETIME", "OPERATIONAL_DEMAND" FROM joined WHERE temperature IS NULL',
    "all_null_rows": _JOINED + " SELECT count(*) AS all_null_rows FROM joined WHERE temperature IS NULL",
    "upsert_by_key": """WITH updates AS (
  SELECT o_custkey AS c_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders GROUP BY 1)
SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM updates)
UNION ALL SELECT * FROM updates""",
    "null_counts": f"""WITH {HALF_TYPE},
featured AS (SELECT *, {_LAGS}, {_rolling(None)} FROM half_t {_windows('PARTITION BY "REGIONID"')}),
counted AS (
  {" UNION ALL ".join(
      f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM featured"
      for c in [f"lag_{k}" for k in (1, 2, 48, 336)]
      + [f"rolling_{s}_{n}" for n in (4, 48) for s in ("mean", "std", "min", "max")]
  )})
SELECT * FROM counted WHERE null_count > 0""",
    "join_left_one_to_one": f"""WITH {HALF},{WEATHER}
SELECT h."INTERVAL_DATETIME", h."OPERATIONAL_DEMAND", {", ".join("w." + c for c in WEATHER_COLUMNS)}
FROM half h LEFT JOIN weather w USING ("INTERVAL_DATETIME")""",
    "join_inner_one_to_one": f"WITH {WEATHER} SELECT * FROM weather",
    "unmatched_keys": f"""WITH {STAMPS},{HOURLY}
SELECT "INTERVAL_DATETIME" FROM stamps WHERE "INTERVAL_DATETIME" NOT IN (SELECT "INTERVAL_DATETIME" FROM hourly)""",
    "extra_keys": f"""WITH {STAMPS},{WEATHER}
SELECT "INTERVAL_DATETIME" FROM weather WHERE "INTERVAL_DATETIME" NOT IN (SELECT "INTERVAL_DATETIME" FROM stamps)""",
    "match_rate": f"""WITH {STAMPS},{HOURLY},
c AS (
  SELECT count(c."INTERVAL_DATETIME") AS left_keys, count(w."INTERVAL_DATETIME") AS right_keys,
         count(*) FILTER (c."INTERVAL_DATETIME" IS NOT NULL AND w."INTERVAL_DATETIME" IS NOT NULL) AS matched,
         count(*) FILTER (w."INTERVAL_DATETIME" IS NULL) AS unmatched,
         count(*) FILTER (c."INTERVAL_DATETIME" IS NULL) AS extra
  FROM stamps c FULL JOIN hourly w ON c."INTERVAL_DATETIME" = w."INTERVAL_DATETIME")
SELECT *, CAST(matched AS DOUBLE) / left_keys AS match_rate FROM c""",
    "merge_report": f"""WITH {STAMPS},{WEATHER},
merged AS (
  SELECT c."REGIONID" AS r, c."INTERVAL_DATETIME" AS t, {", ".join("w." + c for c in WEATHER_COLUMNS)}, w."INTERVAL_DATETIME" AS wt
  FROM half_t c LEFT JOIN weather w ON c."INTERVAL_DATETIME" = w."INTERVAL_DATETIME"),
r AS (
  SELECT (SELECT count(*) FROM half_t) AS demand_rows_before_merge,
         (SELECT count(*) FROM weather) AS weather_rows_before_merge, count(*) AS merged_rows,
         count(DISTINCT wt) AS matched, count(DISTINCT t) - count(DISTINCT wt) AS lost, count(DISTINCT t) AS stamps,
         count(*) - count(DISTINCT (r, t)) AS dup,
         {" + ".join(f"count(*) - count({c})" for c in WEATHER_COLUMNS)} AS gaps
  FROM merged)
SELECT demand_rows_before_merge, weather_rows_before_merge, merged_rows,
       merged_rows - demand_rows_before_merge AS row_difference_vs_demand,
       matched AS matched_timestamp_count, lost AS unmatched_demand_timestamp_count,
       weather_rows_before_merge - matched AS extra_weather_timestamp_count,
       CAST(matched AS DOUBLE) / stamps AS match_rate,
       dup AS duplicate_merged_timestamp_count, gaps AS missing_weather_value_count_after_merge,
       CASE WHEN CAST(matched AS DOUBLE) / stamps < 0.99 OR dup > 0 THEN 'FAIL'
            WHEN gaps > 0 OR lost > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS status
FROM r""",
    "split_overlap": f"""WITH {HALF_TYPE},{split_cte("half_t", 'PARTITION BY "REGIONID"')},
p AS (SELECT "INTERVAL_DATETIME" AS t, bool_or(split = 'train') AS a, bool_or(split = 'validation') AS b,
             bool_or(split = 'test') AS c FROM labelled GROUP BY 1)
SELECT count(*) FILTER (a AND b) AS train_validation, count(*) FILTER (a AND c) AS train_test,
       count(*) FILTER (b AND c) AS validation_test FROM p""",
    "table_profile": """SELECT count(*) AS row_count, CAST(11 AS INTEGER) AS column_count,
  CAST(8 AS INTEGER) AS numeric_column_count FROM lineitem""",
    "target_profile": f"""WITH {HALF_TYPE}
SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS missing_or_non_numeric_count, CAST(0 AS BIGINT) AS infinite_count,
       count(*) FILTER ("OPERATIONAL_DEMAND" <= 0) AS non_positive_count,
       CAST(min("OPERATIONAL_DEMAND") AS DOUBLE) AS minimum, CAST(max("OPERATIONAL_DEMAND") AS DOUBLE) AS maximum,
       avg("OPERATIONAL_DEMAND") AS mean FROM half_t""",
    "infinite_counts": """SELECT * FROM (
  SELECT 'ratio' AS column_name, count(*) FILTER (l_discount = 0) AS infinite_count FROM lineitem
  UNION ALL SELECT 'negative', count(*) FILTER (l_tax = 0) FROM lineitem) WHERE infinite_count > 0""",
    "duplicate_count": """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events))
  AS duplicate_count FROM events""",
    "distinct_series": f'WITH {HALF_TYPE} SELECT DISTINCT "REGIONID" FROM half_t',
    "value_counts": f"""WITH {STEPS},
top AS (SELECT us, count(*) AS n FROM steps_t WHERE us IS NOT NULL GROUP BY 1 ORDER BY n DESC, us LIMIT 10)
SELECT CAST(us // 86400000000 AS VARCHAR) || ' days ' || strftime(to_timestamp((us % 86400000000) / 1000000.0) AT TIME ZONE 'UTC', '%H:%M:%S')
       AS step, n FROM top""",
    "dedup_exact": "SELECT DISTINCT user_id, event_type, ts, value FROM events",
    "dedup_latest": """SELECT event_id, user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1""",
    "regression_metrics": f"""WITH p AS (SELECT l_extendedprice AS a, l_quantity * 1500 AS p FROM lineitem),
m AS (SELECT {_METRICS} FROM p) SELECT {rounded(4, "MAE", "RMSE", "MAPE", "R2")} FROM m""",
    "evaluate_models": f'WITH {BASE} SELECT model, {rounded(6, "MAE", "RMSE", "MAPE", "R2")} FROM comparison',
    "cv_summary": f"""WITH f AS (
  SELECT event_type AS candidate, user_id, CAST(sum({CENTS}) AS DOUBLE) AS v, CAST(min({CENTS}) AS DOUBLE) AS t,
         CAST(count(*) AS DOUBLE) AS s FROM events GROUP BY 1, 2),
g AS (SELECT candidate, avg(v) AS mv, stddev_pop(v) AS sv, avg(t) AS mt, avg(s) AS ms FROM f GROUP BY 1)
SELECT candidate, {fixed("mv", 4)} AS "mean_validation_MAE", {fixed("sv", 4)} AS "std_validation_MAE",
       {fixed("mt", 4)} AS "mean_training_MAE", {fixed("ms", 4)} AS mean_fit_time,
       CAST(rank() OVER (ORDER BY mv) AS INTEGER) AS rank_test_score FROM g""",
    "select_best": f"""WITH {BASE}
SELECT model, {rounded(6, "MAE")} FROM comparison WHERE model IN ('previous_day', 'previous_week')
ORDER BY comparison."MAE", model LIMIT 1""",
    "lag_features": f"WITH {LAG_TYPE} SELECT * FROM lagged_t",
    "rolling_features": f"""WITH {HALF_TYPE} SELECT *, {_rolling(4)} FROM half_t {_windows('PARTITION BY "REGIONID"')}""",
    "diff_features": f"""WITH {WEATHER}
SELECT "INTERVAL_DATETIME", temperature, temperature - lag(temperature, 2) OVER w AS temperature_change_1h,
       temperature - lag(temperature, 6) OVER w AS temperature_change_3h
FROM weather WINDOW w AS (ORDER BY "INTERVAL_DATETIME")""",
    "interval_continuity": f"""WITH {STEPS}
SELECT count(us) AS intervals, count(*) FILTER (us <> 1800000000) AS unexpected_intervals FROM steps_t""",
    "chronological_split": f"""WITH {HALF_TYPE},{split_cte("half_t", 'PARTITION BY "REGIONID"')}
SELECT "REGIONID", "INTERVAL_DATETIME", "OPERATIONAL_DEMAND", split FROM labelled""",
    "expanding_folds": f"""WITH {HALF},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY "INTERVAL_DATETIME") - 1 AS i, count(*) OVER () AS n,
         unnest([0, 1, 2, 3]) AS fold FROM half),
b AS (SELECT *, n - (4 - fold) * (n // 5) AS s FROM numbered)
SELECT "INTERVAL_DATETIME", "OPERATIONAL_DEMAND", CAST(fold AS INTEGER) AS fold,
       CASE WHEN i < s THEN 'train' ELSE 'test' END AS role FROM b WHERE i < s + n // 5""",
    "is_monotonic": """SELECT count(*) FILTER (ts < prev) = 0 AS is_monotonic_increasing
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS prev FROM events)""",
    "sorted_output": f'WITH {HALF_TYPE} SELECT * FROM half_t ORDER BY "REGIONID", "INTERVAL_DATETIME"',
    "sink_csv": f"WITH {HALF_TYPE} SELECT * FROM half_t",
    "top_k": """SELECT l_partkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS importance
FROM lineitem GROUP BY 1 ORDER BY importance DESC, l_partkey LIMIT 15""",
    "union_by_name": """SELECT event_id AS id, value, event_type FROM events
UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders""",
    "missing_intervals": f"WITH {MISSING} SELECT * FROM missing",
    "calendar_features": f"SELECT event_id, ts, {calendar('ts')} FROM events",
    "cyclical_features": f"SELECT event_id, {cyclical('ts', 6)} FROM events",
    "weather_features": f"""WITH {WEATHER} SELECT *, {_DERIVED} FROM weather WINDOW w AS (ORDER BY "INTERVAL_DATETIME")""",
    "string_normalise": """SELECT c_custkey, lower(trim(c_name)) AS name,
  starts_with(lower(trim(c_name)), 'customer') AS has_prefix, suffix(lower(trim(c_name)), '1') AS has_suffix,
  trim(c_mktsegment) || '/' || lower(trim(c_name)) AS path FROM customer""",
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "upsample_linear": f"WITH {WEATHER} SELECT * FROM smooth",
    "expand_precipitation": f"WITH {WEATHER} SELECT * FROM rain",
    "clean_weather": f"WITH {WEATHER} SELECT * FROM weather",
    "clean_series": f"""WITH r AS (
  SELECT event_type AS "REGIONID", time_bucket(INTERVAL '30 minutes', ts) AS "INTERVAL_DATETIME",
         CAST({CENTS} AS DOUBLE) AS "OPERATIONAL_DEMAND", CAST(user_id AS DOUBLE) AS "OPERATIONAL_DEMAND_ADJUSTMENT",
         TRY_CAST(props AS DOUBLE) AS "WDR_ESTIMATE", date_trunc('second', ts) AS "LASTCHANGED",
         strftime(ts, '%Y-%m-%d') AS "SOURCE_FILE", event_id FROM events)
SELECT * EXCLUDE (event_id, k) FROM (
  SELECT *, row_number() OVER (PARTITION BY "REGIONID", "INTERVAL_DATETIME"
                               ORDER BY "LASTCHANGED" DESC, "SOURCE_FILE" DESC, event_id DESC) AS k FROM r) WHERE k = 1""",
    "training_table": f"WITH {TRAIN} SELECT * FROM training",
    "standard_scale": f"""WITH s AS (
  SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2,
         stddev_pop(l_extendedprice) AS s2, avg(l_discount) AS m3, stddev_pop(l_discount) AS s3,
         avg(l_tax) AS m4, stddev_pop(l_tax) AS s4 FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')
SELECT l_orderkey, l_linenumber, {fixed("(l_quantity - m1) / s1", 6)} AS l_quantity,
       {fixed("(l_extendedprice - m2) / s2", 6)} AS l_extendedprice,
       {fixed("(l_discount - m3) / s3", 6)} AS l_discount, {fixed("(l_tax - m4) / s4", 6)} AS l_tax FROM lineitem CROSS JOIN s""",
    "baseline_metrics": f"""WITH {LAG_TYPE},
base AS (SELECT CAST("OPERATIONAL_DEMAND" + 1 AS DOUBLE) AS a, * FROM lagged_t WHERE lag_336 IS NOT NULL),
long AS (
  SELECT 'previous_interval' AS model, a, CAST(lag_1 AS DOUBLE) AS p FROM base
  UNION ALL SELECT 'previous_day', a, CAST(lag_48 AS DOUBLE) FROM base
  UNION ALL SELECT 'previous_week', a, CAST(lag_336 AS DOUBLE) FROM base),
m AS (SELECT model, {_METRICS} FROM long GROUP BY model)
SELECT model, {rounded(4, "MAE", "RMSE", "MAPE", "R2")} FROM m""",
    "linear_regression": two_feature_fit(0.0),
    "ridge_regression": two_feature_fit(1.0),
    "timestamp_profile": """SELECT count(*) FILTER (ts IS NULL) AS invalid_timestamp_count,
  count(*) - count(DISTINCT ts) AS duplicate_timestamp_count, count(*) FILTER (ts < prev) = 0 AS is_monotonic_increasing,
  min(ts) AS minimum_timestamp, max(ts) AS maximum_timestamp
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS prev FROM events)""",
    "series_report": f"""WITH {MISSING}
SELECT count(*) AS rows, min("INTERVAL_DATETIME") AS start_datetime, max("INTERVAL_DATETIME") AS end_datetime,
       CAST(0 AS BIGINT) AS duplicate_intervals, (SELECT count(*) FROM missing) AS missing_interval_count FROM half_t""",
    "demand_report": f"""WITH {HALF}
SELECT count(*) AS row_count, CAST(2 AS INTEGER) AS column_count, CAST(0 AS BIGINT) AS invalid_timestamp_count,
       count(*) - count(DISTINCT "INTERVAL_DATETIME") AS duplicate_timestamp_count, true AS is_monotonic_increasing,
       min("INTERVAL_DATETIME") AS minimum_timestamp, max("INTERVAL_DATETIME") AS maximum_timestamp,
       CAST(0 AS BIGINT) AS missing_or_non_numeric_count, CAST(0 AS BIGINT) AS infinite_count,
       count(*) FILTER ("OPERATIONAL_DEMAND" <= 0) AS non_positive_count,
       CAST(min("OPERATIONAL_DEMAND") AS DOUBLE) AS minimum, CAST(max("OPERATIONAL_DEMAND") AS DOUBLE) AS maximum,
       avg("OPERATIONAL_DEMAND") AS mean, 'PASS' AS status FROM half""",
    "demand_report_dirty": f"""WITH {HALF},
k AS (SELECT *, epoch_us("INTERVAL_DATETIME") // 1800000000 AS k FROM half),
d AS (SELECT CASE WHEN k % 13 <> 0 THEN CASE WHEN k % 17 = 0 THEN "INTERVAL_DATETIME" - INTERVAL '30 minutes' ELSE "INTERVAL_DATETIME" END END AS t,
        CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 11 = 0 THEN 'inf'::DOUBLE ELSE "OPERATIONAL_DEMAND" END END AS y, k * 7919 % 1000003 AS place FROM k),
o AS (SELECT *, lag(t) OVER (ORDER BY place) AS before FROM d),
c AS (SELECT count(*) AS row_count, count(*) FILTER (t IS NULL) AS invalid_timestamp_count,
        count(*) - count(DISTINCT t) - CAST(count(*) FILTER (t IS NULL) > 0 AS BIGINT) AS duplicate_timestamp_count,
        count(*) FILTER (t IS NULL OR t < before) = 0 AS is_monotonic_increasing, count(*) FILTER (y IS NULL) AS missing_or_non_numeric_count,
        count(*) FILTER (isinf(y)) AS infinite_count, count(*) FILTER (y <= 0) AS non_positive_count, min(y) AS minimum FROM o)
SELECT *, CAST((row_count = 0)::INT + (invalid_timestamp_count > 0)::INT + (duplicate_timestamp_count > 0)::INT
          + (missing_or_non_numeric_count > 0)::INT + (infinite_count > 0)::INT AS INTEGER) AS faults,
       CASE WHEN faults > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM c""",
    "fault_messages": f"""WITH {HALF_TYPE},{HALF[1:]},
k AS (SELECT *, epoch_us("INTERVAL_DATETIME") // 1800000000 AS k FROM half),
d AS (SELECT CASE WHEN k % 13 <> 0 THEN "INTERVAL_DATETIME" END AS t, CASE WHEN k % 7 <> 0 THEN "OPERATIONAL_DEMAND" END AS y FROM k),
c AS (SELECT count(*) AS n, count(*) - count(t) AS no_t, count(*) - count(y) AS no_y,
        count(*) - count(DISTINCT t) - CAST(count(*) > count(t) AS BIGINT) AS dup FROM d),
s AS (SELECT count(*) FILTER (step <> INTERVAL '30 minutes') AS uneven FROM (
        SELECT "INTERVAL_DATETIME" - lag("INTERVAL_DATETIME") OVER (PARTITION BY "REGIONID" ORDER BY "INTERVAL_DATETIME") AS step FROM half_t)),
f AS (SELECT 'absent_columns' AS fault, 'events: required columns are absent: [~absent~]' AS message
UNION ALL SELECT 'missing_values', 'demand: missing values in {{~INTERVAL_DATETIME~: ' || no_t || ', ~OPERATIONAL_DEMAND~: ' || no_y || '}}' FROM c
UNION ALL SELECT 'repeated_keys', 'events: ' || (count(*) - count(DISTINCT (user_id, event_type))) || ' repeated key values in [~user_id~, ~event_type~]' FROM events
UNION ALL SELECT 'no_rows', 'events: no rows'
UNION ALL SELECT 'right_side', 'join, right side: ' || (count(*) - count(DISTINCT "INTERVAL_DATETIME")) || ' repeated key values in [~INTERVAL_DATETIME~]' FROM half_t
UNION ALL SELECT 'unknown_series', 'no rows for REGIONID=~absent~; there are ' || count(DISTINCT "REGIONID") || ' others, from ~' || min("REGIONID")
       || '~ to ~' || max("REGIONID") || '~ (distinct_values lists them)' FROM half_t
UNION ALL SELECT 'fit_gaps', 'fit, training part: missing values in [~lag_336~]'
UNION ALL SELECT 'fit_text', 'fit, training part: not numeric: [~event_type~]'
UNION ALL SELECT 'uneven_steps', 'series: ' || uneven || ' intervals differ from 30 minutes' FROM s
UNION ALL SELECT 'failing_report', 'demand: ' || concat_ws(' ', CASE WHEN no_t > 0 THEN 'Some timestamps are missing or unreadable.' END,
       CASE WHEN dup > 0 THEN 'Some timestamps occur more than once.' END, CASE WHEN no_y > 0 THEN 'Some target values are missing or not numeric.' END) FROM c
UNION ALL SELECT 'published', 'False'
UNION ALL SELECT 'saved_report', CASE WHEN no_t + no_y + dup > 0 THEN 'FAIL ' ELSE 'PASS ' END || n FROM c)
SELECT fault, replace(message, '~', chr(39)) AS message FROM f""",
    "weather_requests": f"""WITH {HOURLY},
n AS (SELECT count(*) AS every, count(*) FILTER (day("INTERVAL_DATETIME") = 10) AS tenth FROM hourly)
SELECT 'all' AS request, every AS n_rows, NULL::VARCHAR AS message FROM n UNION ALL SELECT 'place', tenth, NULL FROM n UNION ALL SELECT 'nowhere', 0, NULL
UNION ALL SELECT 'north', 0, 'latitude must lie between -90 and 90' UNION ALL SELECT 'west', 0, 'longitude must lie between -180 and 180'
UNION ALL SELECT 'order', 0, 'start must not be later than end' UNION ALL SELECT 'nothing', 0, 'at least one variable is needed'""",
    "strict_types": """SELECT o_orderkey, o_orderdate AS stamp, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price FROM orders""",
    "published_outputs": f"""WITH {TRAIN},
part_w AS (SELECT * FROM weather WHERE hour("INTERVAL_DATETIME") <> 3),
m AS (SELECT h."INTERVAL_DATETIME" AS t, {" OR ".join(f"s.{c} IS NULL" for c in WEATHER_COLUMNS)} AS gap, s."INTERVAL_DATETIME" AS st
      FROM half h LEFT JOIN part_w s ON h."INTERVAL_DATETIME" = s."INTERVAL_DATETIME")
SELECT 'unmatched_demand_timestamps' AS output, count(*) AS n_rows, min(t) AS "first" FROM m WHERE st IS NULL
UNION ALL SELECT 'extra_weather_timestamps', count(*), min("INTERVAL_DATETIME") FROM part_w WHERE "INTERVAL_DATETIME" NOT IN (SELECT "INTERVAL_DATETIME" FROM half)
UNION ALL SELECT 'merged_rows_with_missing_weather', count(*), min(t) FROM m WHERE gap
UNION ALL SELECT 'training_parquet', count(*), min("INTERVAL_DATETIME") FROM training
UNION ALL SELECT 'training_csv', count(*), min("INTERVAL_DATETIME") FROM training
UNION ALL SELECT 'same_predictions', count(*), min("INTERVAL_DATETIME") FROM training
UNION ALL SELECT 'report', count(*), min("INTERVAL_DATETIME") FROM half
UNION ALL SELECT 'manifest', count(*), NULL FROM training""",
    "training_report_dirty": f"""WITH {TRAIN},
k AS (SELECT *, -(epoch_us("INTERVAL_DATETIME") // 1800000000) AS place FROM training),
d AS (SELECT CASE WHEN place % 5 <> 0 THEN lag_1 END AS lag_1, CASE WHEN place % 9 = 0 THEN 'inf'::DOUBLE ELSE temperature END AS temperature,
        "INTERVAL_DATETIME" AS t, lag("INTERVAL_DATETIME") OVER (ORDER BY place) AS before FROM k),
c AS (SELECT count(*) AS row_count, CAST(35 AS INTEGER) AS feature_count, count(*) - count(lag_1) AS missing_value_count, count(*) - count(lag_1) AS missing_lags,
        count(*) FILTER (isinf(temperature)) AS infinite_temperatures, count(*) FILTER (t < before) = 0 AS is_monotonic_increasing FROM d)
SELECT *, CAST((row_count = 0)::INT + (missing_value_count > 0)::INT + (infinite_temperatures > 0)::INT + (NOT is_monotonic_increasing)::INT AS INTEGER) AS faults,
       CASE WHEN faults > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM c""",
    "weather_report": f"""WITH {WEATHER},
d AS (SELECT *, {_DERIVED} FROM weather WINDOW w AS (ORDER BY "INTERVAL_DATETIME"))
SELECT count(*) AS row_count, CAST(22 AS INTEGER) AS column_count, CAST(21 AS INTEGER) AS weather_feature_count,
       2 * count(*) - count(temperature_change_1h) - count(temperature_change_3h) AS missing_value_count,
       count(*) - count(temperature_change_1h) AS missing_change_1h,
       count(*) - count(temperature_change_3h) AS missing_change_3h, CAST(0 AS INTEGER) AS infinite_columns,
       count(*) - count(DISTINCT "INTERVAL_DATETIME") AS duplicate_timestamp_count, 'PASS' AS status FROM d""",
    "training_report": f"""WITH {TRAIN}
SELECT count(*) AS row_count, CAST(36 AS INTEGER) AS column_count, CAST(34 AS INTEGER) AS feature_count,
       false AS target_in_features, false AS timestamp_in_features, CAST(0 AS INTEGER) AS non_numeric_count,
       CAST(0 AS BIGINT) AS missing_value_count,
       count(*) - count(DISTINCT "INTERVAL_DATETIME") AS duplicate_timestamp_count, true AS is_monotonic_increasing,
       min("INTERVAL_DATETIME") AS minimum_timestamp, max("INTERVAL_DATETIME") AS maximum_timestamp,
       'PASS' AS status FROM training""",
    "split_report": _split_report(f"WITH {TRAIN},{split_cte('training', '')}", 34, 0, ""),
    "split_report_by_series": _split_report(
        f"""WITH {LAG_TYPE},
complete AS (SELECT "REGIONID", "INTERVAL_DATETIME" FROM lagged_t WHERE lag_2 IS NOT NULL),"""
        + split_cte("complete", 'PARTITION BY "REGIONID"'), 3, 1, '"REGIONID", ',
    ),
    "lag_features_raw": f"WITH {RAW} SELECT *, {_LAGS} FROM half_t WINDOW w AS (PARTITION BY \"REGIONID\" ORDER BY \"INTERVAL_DATETIME\")",
    "lag_by_time": f"""WITH {HALF_TYPE}
SELECT a.*, h."OPERATIONAL_DEMAND" AS hour_before, d."OPERATIONAL_DEMAND" AS day_before FROM half_t a
LEFT JOIN half_t h ON h."REGIONID" = a."REGIONID" AND h."INTERVAL_DATETIME" = a."INTERVAL_DATETIME" - INTERVAL '1 hour'
LEFT JOIN half_t d ON d."REGIONID" = a."REGIONID" AND d."INTERVAL_DATETIME" = a."INTERVAL_DATETIME" - INTERVAL '1 day'""",
    "lag_far": f"""WITH {RAW} SELECT *, lag("OPERATIONAL_DEMAND", 501) OVER w AS lag_501, lag("OPERATIONAL_DEMAND", 1500) OVER w AS lag_1500
FROM half_t WINDOW w AS (PARTITION BY "REGIONID" ORDER BY "INTERVAL_DATETIME")""",
    "rolling_features_raw": f"""WITH {RAW} SELECT *, {_rolling(3)} FROM half_t {_windows('PARTITION BY "REGIONID"')}""",
    "chronological_split_raw": f"""WITH {RAW},{split_cte("half_t", 'PARTITION BY "REGIONID"')}
SELECT "REGIONID", "INTERVAL_DATETIME", "OPERATIONAL_DEMAND", split FROM labelled""",
    "missing_intervals_raw": """WITH m AS (
  SELECT DISTINCT event_type AS "REGIONID", date_trunc('minute', ts) AS "INTERVAL_DATETIME" FROM events),
edges AS (SELECT "REGIONID", min("INTERVAL_DATETIME") AS a, max("INTERVAL_DATETIME") AS b FROM m GROUP BY 1),
grid AS (SELECT "REGIONID", unnest(generate_series(a, b, INTERVAL '1 minute')) AS "INTERVAL_DATETIME" FROM edges)
SELECT * FROM grid EXCEPT SELECT * FROM m""",
    "missing_interval_details": f"WITH {MISSING} SELECT * FROM missing",
    "linear_regression_all": _NORMAL,
    "ridge_regression_all": _NORMAL,
    "random_forest": _stated("validation"),
    "gbt_default": _stated("validation"),
    "gbt_custom": _stated("validation"),
    "final_forecast": _stated("test"),
    "rf_importance": _IMPORTANCE,
    "gbt_importance": _IMPORTANCE,
    "gbt_tuned": "SELECT CAST(r AS INTEGER) AS rank_test_score, true AS valid FROM range(1, 3) AS t(r)",
    "model_comparison": f"""WITH {TRAIN},{split_cte("training", "")},
base AS (SELECT CAST("OPERATIONAL_DEMAND" + 1 AS DOUBLE) AS a, * FROM labelled WHERE split = 'validation'),
long AS (
  SELECT 'previous_interval' AS model, a, CAST(lag_1 AS DOUBLE) AS p FROM base
  UNION ALL SELECT 'previous_day', a, CAST(lag_48 AS DOUBLE) FROM base
  UNION ALL SELECT 'previous_week', a, CAST(lag_336 AS DOUBLE) FROM base),
m AS (SELECT model, {_METRICS} FROM long GROUP BY model)
SELECT model, true AS finite, {rounded(4, "MAE", "RMSE", "MAPE", "R2")} FROM m
UNION ALL SELECT unnest(['linear_regression', 'ridge_regression', 'random_forest', 'default_boosted', 'tuned_boosted']),
  true, NULL, NULL, NULL, NULL""",
    "model_output_report": f"""WITH {BASE}
SELECT 'previous_interval' AS selected_model, true AS selected_model_present_in_comparison,
       (SELECT count(*) FROM comparison) AS comparison_row_count, count(*) AS test_prediction_row_count,
       CAST(0 AS BIGINT) AS test_prediction_missing_value_count, CAST(0 AS INTEGER) AS non_finite_columns,
       'PASS' AS status FROM base""",
}
