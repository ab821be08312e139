"""Helpers shared by the training-data operators: stored steps, worker imports and memory, ranks without one-task sorts."""

from __future__ import annotations

import ctypes
import math
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: weakref.WeakSet = weakref.WeakSet()
#: Bytes of a batch that Spark sends to Python, unless the session sets its own bound. A batch is held several times on its way.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that a job started from any folder can import it."""
    sc = spark.sparkContext
    if sc in _SHIPPED:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{PACKAGE.name}_lib", "zip", PACKAGE.parent, PACKAGE.name)
    sc.addPyFile(archive)  # read on the driver and served by Spark itself
    _SHIPPED.add(sc)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Unset: a temporary folder, for local masters only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step below the shared folder and go on from the table: lineage ends, lost executors recompute nothing before it."""
    path = f"{shared_folder(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_parts(spark: SparkSession, parts: Iterator[pa.Table], schema: str, label: str) -> DataFrame:
    """Write tables that the driver makes one after the other, and read them as one; it holds one at a time."""
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a slice hold about ``most_bytes``; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Return what is free inside this process to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` for steps that need much memory: batches are bounded by bytes, and nothing stays with idle workers.

    Workers outlive their tasks, so what one of them keeps would add to all later steps, in Python or not.
    """
    if df.sparkSession.conf.get(BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(told, schema)


def hashed_ranks(df: DataFrame, key: str, order: list[str | Column], rows: int, name: str) -> DataFrame:
    """Number the rows of each ``key`` from 0 in a fixed pseudo-random order, without sorting a key in one task.

    The rows of a key are cut by the leading bits of a hash of ``order`` into parts of about the square root of the
    table (256 at least). Parts are counted first, which gives each part its offset; rows are then numbered inside
    their part. The largest unit of work is one part, or the list of parts of one key. ``rows`` is the table's row count.
    """
    width = max(256, math.isqrt(max(rows, 1)))
    bits = min(40, max(0, math.ceil(math.log2(max(1, rows) / width))))
    hashed = F.xxhash64(*order)
    parted = df.withColumn("__hash", hashed).withColumn("__part", F.shiftrightunsigned("__hash", 64 - bits) if bits else F.lit(0).cast("long"))
    sizes = parted.groupBy(key, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(key).alias("__key"), F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(key, "__part").orderBy("__hash", *order)
    numbered = parted.withColumn("__row", F.row_number().over(inside) - 1)
    joined = numbered.join(offsets, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__of")))
    return joined.withColumn(name, F.col("__row") + F.col("__offset")).drop("__hash", "__part", "__key", "__of", "__offset", "__row")
