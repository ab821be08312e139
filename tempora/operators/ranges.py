"""Positions in an order that no task has to hold: order statistics by histograms, and blocks cut at sampled quantiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tempora.functions.timeline import micros, shift
from tempora.operators.chunks import CHUNK_ROWS, null_safe_join
from tempora.session import materialise, sized

#: Bins of one histogram of a series, and the rows of a bin that are ordered instead of being cut again.
BINS, LEAF_ROWS = 4096, 65_536
#: Blocks that a table is dealt into, unless they would hold over CHUNK_ROWS rows: each costs a task, a stored file and its
#: share of the sampled borders, all of which the driver hears of.
MOST_BLOCKS = 512


def _windows(asked: DataFrame, series: tuple[str, ...]) -> DataFrame:
    """The distinct ranges asked about, one row a series: as many as positions are asked for, at most."""
    return asked.groupBy(*series).agg(F.collect_set(F.struct("__lo", "__width")).alias("__windows"))


def _hits(rows: DataFrame, asked: DataFrame, series: tuple[str, ...]) -> DataFrame:
    """Rows with each of the asked ranges (``__lo``, ``__width``) that they lie in."""
    windows = _windows(asked, series)
    met = null_safe_join(rows, sized(windows, "windows"), series, "inner") if series else rows.withColumn("__windows", windows.scalar())
    inside = F.filter("__windows", lambda w: (F.col("__t") >= w["__lo"]) & (F.col("__t") < w["__lo"] + w["__width"]))
    return met.withColumn("__w", F.explode(inside)).select(*rows.columns, "__w.__lo", "__w.__width")


def _narrowed(rows: DataFrame, asked: DataFrame, series: tuple[str, ...], bins: int) -> DataFrame:
    """One histogram: every asked position moves into the bin that holds it."""
    step = F.expr(f"(__width + {bins - 1}) div {bins}")
    hits = _hits(rows, asked, series).withColumn("__bin", F.expr(f"(__t - __lo) div ((__width + {bins - 1}) div {bins})"))
    counted = hits.groupBy(*series, "__lo", "__width", "__bin").agg(F.count(F.lit(1)).alias("__n"))
    running = Window.partitionBy(*series, "__lo", "__width").orderBy("__bin")  # BINS rows at most
    placed = counted.withColumn("__start", F.sum("__n").over(running) - F.col("__n"))
    found = null_safe_join(asked, placed, (*series, "__lo", "__width"), "inner")
    offset = F.col("__rank") - F.col("__start")
    held = found.filter((offset >= 0) & (offset < F.col("__n")))
    return held.select(
        *series,
        "__i",
        offset.alias("__rank"),
        (F.col("__lo") + F.col("__bin") * step).alias("__lo"),
        step.alias("__width"),
        F.col("__n").alias("__span"),
    )


def order_statistics(
    df: DataFrame,
    ranks: Callable[[Column], Column],
    ts: str,
    series: tuple[str, ...] = (),
    bins: int = BINS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Timestamps at given 0-based positions of each series (missing ones come last), without ordering the series.

    ``ranks`` maps the series' row count to an array of positions. The range of a series is cut into ``bins`` equal parts that
    are counted map-side; running counts name the part that holds each position. Parts of more than ``leaf_rows`` rows are
    cut again, the others are ordered: three passes over the timestamps, one more for each further factor of ``bins`` in
    density. Returns one row per series with ``cuts``, a map from the index in the array to the timestamp; positions
    before the first row, past the end or at missing timestamps are absent.
    """
    rows = df.select(*series, F.col(ts).alias("__ts")).withColumn("__t", micros("__ts"))
    known = rows.groupBy(*series).agg(F.count(F.lit(1)).alias("__total"), F.count("__t").alias("__span"), F.min("__t").alias("__lo"), F.max("__t").alias("__hi"))
    asked = known.select(*series, F.posexplode(ranks(F.col("__total"))).alias("__i", "__rank"), "__lo", (F.col("__hi") - F.col("__lo") + 1).alias("__width"), "__span")
    asked = asked.filter((F.col("__rank") >= 0) & (F.col("__rank") < F.col("__span"))).select(*series, "__i", "__rank", "__lo", "__width", "__span")
    wide = (F.col("__span") > leaf_rows) & (F.col("__width") > 1)
    while True:
        asked = materialise(asked, "positions")
        if asked.filter(wide).isEmpty():
            break
        asked = _narrowed(rows, asked.filter(wide), series, bins).unionByName(asked.filter(~wide))
    # A part one microsecond wide holds one timestamp; the rows of the other parts are few and are ordered.
    single = asked.filter("__width = 1").withColumn("__epoch", F.lit("1970-01-01").cast("timestamp_ntz"))
    entries = single.select(*series, "__i", shift("__epoch", "__lo").cast(df.schema[ts].dataType).alias("__ts"))
    leaves = asked.filter("__width > 1")
    inside = Window.partitionBy(*series, "__lo", "__width").orderBy("__t")
    ordered = _hits(rows, leaves, series).withColumn("__rank", (F.row_number().over(inside) - 1).cast("bigint"))
    found = null_safe_join(leaves, ordered, (*series, "__lo", "__width", "__rank"), "inner").select(*series, "__i", "__ts")
    entry = F.struct(F.col("__i").alias("i"), F.col("__ts").alias("ts"))
    return entries.unionByName(found).groupBy(*series).agg(F.map_from_entries(F.collect_list(entry)).alias("cuts"))


def ranged_blocks(df: DataFrame, order: Sequence[str], block_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` dealt into blocks of about ``block_rows`` rows that follow one another in ``order``, with the block's number.

    Blocks are larger where more than MOST_BLOCKS of them would be needed. Borders are quantiles that Spark samples, so positions
    may be as uneven as they like; equal ones share a block.
    """
    rows = df.select(*order).count()
    blocks = max(1, min(-(-rows // block_rows), max(MOST_BLOCKS, -(-rows // CHUNK_ROWS))))
    return df.repartitionByRange(blocks, *order).withColumn("__block", F.spark_partition_id())


def row_index(df: DataFrame, ts: str, series: tuple[str, ...] = (), name: str = "row_index", block_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df``, stored, with the 0-based position of each row in its series, by ``ts`` (missing ones first).

    Rows are dealt into ranges of (series, ts) and ordered there once; a range's offset in a series is the sum of the
    counts before it, one number per range and series.
    """
    order = [*series, ts]
    dealt = ranged_blocks(df, order, block_rows).sortWithinPartitions(*order)
    placed = materialise(dealt.withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "indexed")
    counts = placed.groupBy(*series, "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    before = Window.partitionBy(*(series or [F.lit(0)])).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select(*series, "__block", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__move"))
    joined = null_safe_join(placed, moved, (*series, "__block"), "inner")
    return joined.withColumn(name, F.col("__pos") + F.col("__move")).select(*df.columns, name)
