"""Records that go over several lines: quoted fields with line breaks, put together without reading a file in one task.

What a line does to the reader depends on whether it begins inside a quoted field, so a line is one of four maps between
"outside" and "inside": it leaves the state, turns it, or ends outside or inside whatever came before. Maps combine: first
the lines of each split of a file, then the splits of the file, one row each; after that every line knows where it begins.
Only lines of records that are not whole are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tempora.errors import IngestError
from tempora.schemas import SOURCE_FILE
from tempora.session import materialise, sized

#: Fields with their commas, then a quoted field that does not end. Quotes count at the start of a field only; a doubled one
#: stands for itself.
OPEN_AT_END = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+$'
#: A longer record is taken for a quote that was never closed.
MOST_LINES = 10_000


def ends_open(line: Column) -> Column:
    """Whether a line that begins outside a quoted field ends inside one."""
    return F.coalesce(F.contains(line, F.lit('"')) & line.rlike(OPEN_AT_END), F.lit(False))


def _composed(df: DataFrame, partition: list[str], order: str) -> DataFrame:
    """The map of all rows up to each row, in ``order``: ``__fixed`` (the state, if any row sets it) and ``__flip`` (whether they turn it)."""
    upto = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sets, turns = F.col("__out") == F.col("__in"), F.col("__out") & ~F.col("__in")
    counted = df.withColumn("__turns", F.sum(turns.cast("long")).over(upto))
    last = F.last(F.when(sets, F.struct(F.col("__out").alias("state"), F.col("__turns").alias("turns"))), ignorenulls=True).over(upto)
    known = counted.withColumn("__set", last)
    odd = lambda n: n % 2 == 1
    fixed = F.when(F.col("__set").isNotNull(), F.col("__set.state") != odd(F.col("__turns") - F.col("__set.turns")))
    return known.withColumns({"__fixed": fixed, "__flip": odd(F.col("__turns"))}).drop("__turns", "__set")


def whole_records(lines: DataFrame, broken: DataFrame, position: str, split_lines: int) -> DataFrame:
    """``lines`` with one row per record in the files that ``broken`` names: texts joined by line feeds, at their first position.

    Lines are ordered once, inside their split, and stored with what they are in either state that the split may begin in; one row a
    split then tells which holds. The records are stored as well: their readers pass over them several times.
    """
    files, rest = lines.join(broken, SOURCE_FILE, "left_semi"), lines.join(broken, SOURCE_FILE, "left_anti")
    split, row = F.expr(f"`{position}` div {split_lines}"), F.expr(f"cast(`{position}` % {split_lines} as bigint)")
    value = F.col("value")
    mapped = files.withColumns({"__split": split, "__row": row, "__out": ends_open(value), "__in": ends_open(F.concat(F.lit('"'), value))})
    inside = _composed(mapped, [SOURCE_FILE, "__split"], "__row")
    by_split = Window.partitionBy(SOURCE_FILE, "__split").orderBy("__row")
    upto = by_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = ("out", "in")
    # Where a line ends, whether it is the first of a record, and the records of the split so far: for each state before the split.
    inside = inside.withColumns({"__ends_out": F.coalesce("__fixed", "__flip"), "__ends_in": F.coalesce(F.col("__fixed"), ~F.col("__flip"))})
    inside = inside.withColumns({f"__first_{s}": F.coalesce(~F.lag(f"__ends_{s}", 1).over(by_split), F.lit(s == "out")) for s in states})
    inside = inside.withColumns({f"__number_{s}": F.sum(F.col(f"__first_{s}").cast("long")).over(upto) for s in states})
    kept = [f"__{what}_{s}" for what in ("ends", "first", "number") for s in states]
    inside = materialise(inside.select(*lines.columns, "__split", "__row", *kept), "lines")
    # One row a split: the map of all its lines and their records, then the state in which it begins.
    last = [F.max_by(f"__ends_{s}", "__row").alias(f"__{s}") for s in states]
    splits = inside.groupBy(SOURCE_FILE, "__split").agg(*last, *[F.max(f"__number_{s}").alias(f"__n_{s}") for s in states])
    by_file = Window.partitionBy(SOURCE_FILE).orderBy("__split")
    begun = _composed(splits, [SOURCE_FILE], "__split").withColumn("__begins", F.lag(F.coalesce("__fixed", "__flip"), 1, False).over(by_file))
    # A split that begins inside a record goes on with the last record of the splits before.
    counted = begun.withColumn("__n", F.when(F.col("__begins"), F.col("__n_in")).otherwise(F.col("__n_out")))
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("__n") > 0, F.struct(F.col("__split").alias("split"), F.col("__n").alias("number"))), ignorenulls=True).over(before)
    starts = sized(counted.select(SOURCE_FILE, "__split", "__begins", owner.alias("__owner")), "splits")
    at = inside.join(starts, [SOURCE_FILE, "__split"])
    at = at.withColumns({f"__{what}": F.when(F.col("__begins"), F.col(f"__{what}_in")).otherwise(F.col(f"__{what}_out")) for what in ("ends", "first", "number")})
    own = F.struct(F.col("__split").alias("split"), F.col("__number").alias("number"))
    at = at.withColumn("__record", F.when(F.col("__number") > 0, own).otherwise(F.col("__owner")))
    whole = F.col("__first") & ~F.col("__ends")
    parts = at.filter(~whole)
    longest = parts.groupBy(SOURCE_FILE, "__record").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST_LINES)
    found = longest.agg(F.min(SOURCE_FILE)).first()[0]
    if found:
        raise IngestError(f"a quoted field of more than {MOST_LINES} lines: {found}")
    others = [c for c in lines.columns if c not in (SOURCE_FILE, position, "value")]
    pieces = F.sort_array(F.collect_list(F.struct(position, "value")))
    grouped = parts.groupBy(SOURCE_FILE, "__record").agg(F.min(position).alias(position), pieces.alias("p"), *[F.max(c).alias(c) for c in others])
    joined = grouped.withColumn("value", F.array_join(F.transform("p", lambda p: p["value"]), "\n"))
    records = materialise(at.filter(whole).select(*lines.columns).unionByName(joined.select(*lines.columns)), "records")
    return rest.unionByName(records)
