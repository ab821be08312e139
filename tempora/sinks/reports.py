"""JSON form of one-row reports."""

from __future__ import annotations

import datetime as dt
import json
import math
from pathlib import PurePath

from pyspark.sql import DataFrame, Row, SparkSession


def plain(value):
    """JSON-ready form: ISO timestamps, durations as text, NaN as null, string keys."""
    if isinstance(value, Row):
        return plain(value.asDict())
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (dt.timedelta, PurePath)):
        return str(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def report_dict(report: DataFrame) -> dict:
    """The single row of a report as plain values."""
    rows = report.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"a report has exactly one row, got {len(rows)} or more")
    return plain(rows[0])


def write_report(spark: SparkSession, content: dict, path: str) -> None:
    """One pretty-printed JSON document, through Spark so that any supported file system works."""
    text = json.dumps(plain(content), indent=4, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
