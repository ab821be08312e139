"""Session construction and the shared scratch location."""

from __future__ import annotations

import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

# Derived key tables up to this many rows are broadcast (tens of MB); larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
_SHIPPED: weakref.WeakSet = weakref.WeakSet()
_SCOPES: list[str] = []


def build_session(app_name: str = "tempora", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    Timestamps are zone-less (``TIMESTAMP_NTZ``), so the session zone is pinned to UTC.
    ANSI stays on: strict casts must raise. AQE coalesces and splits shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, so that jobs may start from any folder."""
    sc = spark.sparkContext
    if sc not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}_lib", "zip", package.parent, package.name)
        sc.addPyFile(archive)  # read on the driver, served by Spark
        _SHIPPED.add(sc)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a temporary folder if it is unset and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tempora-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, inside the scratch scope if one is open."""
    return "/".join([checkpoint_root(spark).rstrip("/"), "tempora", *_SCOPES[-1:], f"{label}-{uuid.uuid4().hex}"])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Stored steps of the block share one folder, removed when the block ends well: frames made inside are read no more then.

    After an error the folder stays, for a look at what the step had read.
    """
    from tempora.sinks.runs import remove_path

    _SCOPES.append(f"scope-{uuid.uuid4().hex}")
    folder = f"{checkpoint_root(spark).rstrip('/')}/tempora/{_SCOPES[-1]}"
    try:
        yield folder
    finally:
        _SCOPES.pop()
    remove_path(spark, folder)


def materialise(df: DataFrame, label: str = "table", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write once below the shared folder and continue from the stored table.

    Cuts lineage, survives the loss of executors, and, being Parquet, keeps column pruning and size
    statistics for the steps that follow.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, label: str = "keys") -> DataFrame:
    """Store a derived key table, count it, and mark it for broadcast only when it is small enough."""
    stored = materialise(df, label)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored
