"""Tagged-record CSV: ``C`` lines are metadata, ``I`` names the columns, ``D`` carries data.

Files are read as lines, so a large file splits over tasks, and parsed with Spark's CSV expression.
Two passes: the first finds the headers and checks the layout (one row per file after map-side
aggregation), the second parses. If the first meets a line that ends inside a quoted field, records that go over several lines
are put together before both (``sources.records``).
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tempora.errors import IngestError
from tempora.schemas import RECORD_COLUMNS, SOURCE_FILE
from tempora.session import materialise
from tempora.sources.records import ends_open, whole_records

CORRUPT = "__corrupt"
POSITION = "_position"
CSV_GLOB = "*.[cC][sS][vV]"
# A header table of at most this many files is broadcast; beyond it Spark chooses.
BROADCAST_FILES = 100_000
# CSV options that keep values exactly as they stand between the separators.
CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "\u0000",
    "maxCharsPerColumn": "-1",
}


def record_tag(line: Column) -> Column:
    """First field of a line, unquoted and trimmed."""
    return F.trim(F.regexp_extract(line, r'^"?([^",]*)', 1))


def header_names(header: str) -> list[str]:
    """Column names of an ``I`` line; the first four are fixed."""
    names = next(csv.reader([header]))
    return [*RECORD_COLUMNS, *names[4:]]


def read_lines(spark: SparkSession, path: str, glob: str = CSV_GLOB) -> DataFrame:
    """(SOURCE_FILE, _position, value) for the files directly below ``path``.

    ``_position`` orders the lines of one file: the offset of the split, then the row inside the
    task (the low 33 bits of the generated id). One number, so that aggregates on it stay hashed.
    Line breaks inside a field count as they stand between lines: each becomes one ``\\n``.
    """
    lines = spark.read.text(path, pathGlobFilter=glob)
    return lines.select(
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.expr(
            "cast(_metadata.file_block_start as decimal(28,0)) * 8589934592"
            " + (monotonically_increasing_id() & 8589934591)"
        ).cast("decimal(38,0)").alias(POSITION),
        "value",
    )


def _structure(lines: DataFrame) -> DataFrame:
    """One row per file: last header, data rows, lines that are not UTF-8, unreadable archives.

    Header text and error text are grouping keys first, so the pass over all lines is a hashed
    aggregate on numbers; only its small result is reduced by ``max_by``.
    """
    error = F.col("error") if "error" in lines.columns else F.lit(None).cast("string")
    tag = record_tag(F.col("value"))
    per_text = lines.groupBy(
        SOURCE_FILE, F.when(tag == "I", F.col("value")).alias("text"), error.alias("error")
    ).agg(
        F.max(POSITION).alias("last"),
        F.count_if(tag == "D").alias("data_rows"),
        F.count_if(~F.is_valid_utf8("value")).alias("undecodable"),
        F.count_if(ends_open(F.col("value"))).alias("open_lines"),
    )
    return per_text.groupBy(SOURCE_FILE).agg(
        F.max_by("text", F.when(F.col("text").isNotNull(), F.col("last"))).alias("header"),
        F.sum("data_rows").alias("data_rows"),
        F.sum("undecodable").alias("undecodable"),
        F.sum("open_lines").alias("open_lines"),
        F.max("error").alias("error"),
    )


def _headers(structure: DataFrame) -> list:
    """One row per distinct header text. Distinct headers are schema versions of the feed, not data."""

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col(SOURCE_FILE)))

    return (
        structure.groupBy("header")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(SOURCE_FILE).alias("first"),
            first(F.col("error").isNotNull()).alias("unreadable"),
            first(F.col("undecodable") > 0).alias("undecodable"),
            first(F.col("data_rows") == 0).alias("empty"),
            F.sum("open_lines").alias("open_lines"),
        )
        .collect()
    )


def _checked(found: list, check_encoding: bool) -> dict[str, int]:
    """Header text -> number of files, once the layout is right."""

    def stop(files: list[str | None], what: str) -> None:
        named = sorted(f for f in files if f)
        if named:
            raise IngestError(f"{what}: {named[0]}")

    stop([r["unreadable"] for r in found], "not a valid ZIP archive")
    if check_encoding:
        stop([r["undecodable"] for r in found], "not valid UTF-8")
    stop([r["first"] for r in found if r["header"] is None], "no header record ('I')")
    stop([r["first"] for r in found if len(next(csv.reader([r["header"]]))) < 4], "header record with fewer than four fields")
    stop([r["empty"] for r in found], "no data records ('D')")
    return {r["header"]: r["n"] for r in found}


def parse_tagged_lines(
    lines: DataFrame, check_encoding: bool = False, eager: bool = False, listing: list[str] | None = None, split_lines: int = 1 << 33
) -> DataFrame:
    """Data rows as text columns plus SOURCE_FILE and _position.

    The last ``I`` line of a file names the columns of all its rows. Files with different headers
    are aligned by column name. Layout errors raise at once. A data record whose field count differs
    from its header fails the job that reads its values, at no extra cost; ``eager`` spends one more pass to
    raise here instead, with the number of such records. ``listing`` names the files that must be there;
    ``_position`` div ``split_lines`` numbers the splits of a file, in which broken records are looked for side by side.
    """
    structure = _structure(lines)
    found = _headers(structure)
    if any(r["open_lines"] for r in found):
        broken = structure.filter("open_lines > 0").select(SOURCE_FILE)
        lines = whole_records(lines, materialise(broken, "broken-files"), POSITION, split_lines)
        structure = _structure(lines)
        found = _headers(structure)
    headers = _checked(found, check_encoding)
    if not headers:
        raise IngestError("no CSV input found")
    if listing is not None and len(listing) != sum(headers.values()):
        # Files without a line have no row anywhere else. Listed names are escaped as in addresses.
        plain_name = F.url_decode(F.replace(F.col(SOURCE_FILE), F.lit("+"), F.lit("%2B"))).alias("__name")
        listed = lines.sparkSession.createDataFrame([(f,) for f in listing], f"{SOURCE_FILE} string").select(plain_name)
        empty = listed.join(structure.select(plain_name), "__name", "left_anti").agg(F.min("__name")).first()[0]
        if empty:
            raise IngestError(f"no header record ('I'): {empty}")
    data = lines.filter(record_tag(F.col("value")) == "D")
    known = sorted(headers)
    if len(known) > 1:
        per_file = structure.select(SOURCE_FILE, "header")
        if sum(headers.values()) <= BROADCAST_FILES:
            per_file = F.broadcast(per_file)
        data = data.join(per_file, SOURCE_FILE)
    parsed: list[tuple[list[str], Column]] = []
    for header in known:
        names = header_names(header)
        if len(set(names)) != len(names):
            raise IngestError(f"repeated column names in a header record: {header}")
        # Positional field names: header text may contain any character.
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]).simpleString()
        value = F.from_csv("value", schema, CSV_OPTIONS)
        parsed.append((names, value if len(known) == 1 else F.when(F.col("header") == header, value)))
    wide = data.withColumns({f"__p{i}": column for i, (_, column) in enumerate(parsed)})
    corrupt = [F.col(f"__p{i}.{CORRUPT}") for i in range(len(parsed))]
    broken = F.coalesce(*corrupt).isNotNull()
    what = "data records whose field count differs from the header"
    if eager:
        row = wide.filter(broken).agg(F.min(SOURCE_FILE).alias("first"), F.count(F.lit(1)).alias("n")).first()
        if row["n"]:
            raise IngestError(f"{row['n']} {what}: {row['first']}")
    order: list[str] = []
    for names, _ in parsed:
        order += [n for n in names if n not in order]

    def field(i: int, position: int) -> Column:
        # The parser reports an empty field as null; in a feed of texts it is an empty text.
        return F.when(F.col(f"__p{i}").isNotNull(), F.coalesce(F.col(f"__p{i}.c{position}"), F.lit("")))

    def guarded(value: Column) -> Column:
        # On the values rather than in a filter, which would be pushed down and parse the line twice.
        if eager:
            return value
        return F.when(broken, F.raise_error(F.concat(F.lit(f"{what}: "), F.col(SOURCE_FILE)))).otherwise(value)

    columns = [
        guarded(F.coalesce(*[field(i, names.index(n)) for i, (names, _) in enumerate(parsed) if n in names])).alias(n)
        for n in order
    ]
    return wide.select(*columns, guarded(F.col(SOURCE_FILE)).alias(SOURCE_FILE), POSITION)


def read_tagged_csv(spark: SparkSession, path: str, eager: bool = False) -> DataFrame:
    """All ``.csv`` files (any letter case) directly below ``path``, or one file. Strict UTF-8."""
    lines = read_lines(spark, path)
    # Empty files yield no line, so only the listing, which Spark holds on the driver anyway, knows them.
    listing = [name.rsplit("/", 1)[-1] for name in lines.inputFiles()]
    return parse_tagged_lines(lines, check_encoding=True, eager=eager, listing=listing)


def ingest_summary(df: DataFrame) -> DataFrame:
    """Archives, nested archives, files and rows, from the provenance column."""
    parts = F.split(SOURCE_FILE, "/")
    files = df.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n"))
    nested = F.filter(parts, lambda p: F.lower(p).endswith(".zip"))
    paths = files.select(
        "n",
        F.when(F.size(nested) >= 1, nested[0]).alias("outer"),
        F.when(F.size(nested) >= 2, F.array_join(nested, "/")).alias("inner"),
    )
    return paths.agg(
        F.count_distinct("outer").alias("archives"),
        F.count_distinct("inner").alias("nested_archives"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("data_rows"),
    )
