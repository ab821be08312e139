"""Outputs of a run as one unit: written to a folder of their own, visible once a manifest names it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tempora.errors import GuardError
from tempora.sinks.reports import plain, write_report

MANIFEST = "manifest.json"


class RunFolder:
    """``output/runs/<id>``: what a run writes there counts only after :meth:`publish`.

    A run that stops half-way leaves its folder, with the reports saved so far, and the manifest of the run before. Readers go
    through the manifest, so they see one run or another, never parts of two.
    """

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output, self.id = spark, output.rstrip("/"), uuid.uuid4().hex
        self.root = f"{self.output}/runs/{self.id}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def publish(self, summary: dict | None = None) -> dict:
        """Name this run in the manifest; its single small file replaces the one before."""
        found = {"run": self.id, "folder": self.root, "summary": plain(summary or {})}
        write_report(self.spark, found, f"{self.output}/{MANIFEST}")
        return found


def published(spark: SparkSession, output: str) -> dict:
    """The manifest of the published run."""
    path = f"{output.rstrip('/')}/{MANIFEST}"
    if not path_exists(spark, path):
        raise GuardError(f"no published run in {output}")
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_json_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A saved report as one row; absent keys are null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, fs = _filesystem(spark, path)
    return fs.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    place, fs = _filesystem(spark, path)
    fs.delete(place, True)
