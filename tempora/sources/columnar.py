"""Columnar JSON: parallel arrays below ``hourly`` become rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tempora.errors import IngestError
from tempora.functions.casts import strict_timestamp
from tempora.schemas import HOURLY_VARIABLES, columnar_schema

METADATA = [
    "latitude",
    "longitude",
    "elevation",
    "timezone",
    "timezone_abbreviation",
    "utc_offset_seconds",
    "hourly_units",
]
_CORRUPT = "__corrupt"


def check_request(
    start: str | dt.date | None,
    end: str | dt.date | None,
    latitude: float | None,
    longitude: float | None,
    variables: list[str],
) -> None:
    """Argument rules of a weather extract."""
    if start is not None and end is not None and str(start) > str(end):
        raise ValueError("start must not be later than end")
    if latitude is not None and not -90 <= latitude <= 90:
        raise ValueError("latitude must lie between -90 and 90")
    if longitude is not None and not -180 <= longitude <= 180:
        raise ValueError("longitude must lie between -180 and 180")
    if not variables:
        raise ValueError("at least one variable is needed")


def read_payloads(
    spark: SparkSession, path: str, variables: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Landed documents with an explicit schema: no inference pass."""
    variables = HOURLY_VARIABLES if variables is None else variables
    schema = columnar_schema(variables).add(_CORRUPT, "string")
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(path)
    )


def check_payloads(payloads: DataFrame, variables: list[str]) -> None:
    """All payload guards in one aggregate."""
    n = F.size("hourly.time")
    lengths = F.array(*[F.size(f"hourly.{v}") for v in variables])
    present = {v: F.count_if(F.col(f"hourly.{v}").isNull()) for v in variables}
    corrupt = F.col(_CORRUPT).isNotNull() if _CORRUPT in payloads.columns else F.lit(False)
    row = payloads.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(corrupt).alias("corrupt"),
        F.count_if("error").alias("errors"),
        F.min(F.when(F.col("error"), F.coalesce("reason", F.lit("unknown error")))).alias("reason"),
        F.count_if(F.col("hourly").isNull()).alias("no_hourly"),
        F.count_if(F.col("hourly.time").isNull()).alias("no_time"),
        F.count_if(n == 0).alias("empty"),
        F.count_if(F.exists(lengths, lambda k: k != n)).alias("ragged"),
        *[c.alias(f"v_{v}") for v, c in present.items()],
    ).first()
    if not row["n"]:
        raise IngestError("no weather documents")
    if row["corrupt"]:
        raise IngestError("a weather document is not valid JSON")
    if row["errors"]:
        raise IngestError(row["reason"])
    if row["no_hourly"]:
        raise IngestError("a weather document has no hourly block")
    if row["no_time"]:
        raise IngestError("a weather document has no timestamps")
    if row["empty"]:
        raise IngestError("a weather document has no observations")
    absent = sorted(v for v in variables if row[f"v_{v}"])
    if absent:
        raise IngestError(f"weather documents lack variables: {absent}")
    if row["ragged"]:
        raise IngestError("the arrays of a weather document differ in length")


def payload_rows(
    payloads: DataFrame,
    variables: list[str] | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    check: bool = True,
) -> DataFrame:
    """One row per observation: ``time`` plus the variables; ``start``/``end`` are inclusive dates."""
    variables = HOURLY_VARIABLES if variables is None else variables
    check_request(start, end, None, None, variables)
    if check:
        check_payloads(payloads, variables)
    zipped = F.arrays_zip("hourly.time", *[f"hourly.{v}" for v in variables])
    rows = payloads.select(F.explode(zipped).alias("o")).select(
        strict_timestamp(F.col("o.time")).alias("time"), *[F.col(f"o.{v}").alias(v) for v in variables]
    )
    if start is not None:
        rows = rows.filter(F.col("time").cast("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        rows = rows.filter(F.col("time").cast("date") <= F.lit(str(end)).cast("date"))
    return rows


def payload_metadata(payloads: DataFrame) -> DataFrame:
    """Location, zone and units of each document."""
    units = F.coalesce("hourly_units", F.from_json(F.lit("{}"), "map<string,string>"))
    return payloads.select(*METADATA[:-1], units.alias("hourly_units"))


def read_columnar_json(
    spark: SparkSession,
    path: str,
    variables: list[str] | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    multi_line: bool = True,
    latitude: float | None = None,
    longitude: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(observations, metadata) of the documents at ``path``; with a place, of that place's documents only."""
    variables = HOURLY_VARIABLES if variables is None else variables
    check_request(start, end, latitude, longitude, variables)
    payloads = read_payloads(spark, path, variables, multi_line)
    place = {k: v for k, v in (("latitude", latitude), ("longitude", longitude)) if v is not None}
    for name, value in place.items():
        payloads = payloads.filter(F.col(name) == F.lit(float(value)))
    # A place without documents has no rows; a path without any is an error.
    check = not place or not payloads.isEmpty()
    return payload_rows(payloads, variables, start, end, check), payload_metadata(payloads)
