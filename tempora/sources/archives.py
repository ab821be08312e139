"""CSV members of ZIP archives, directly or inside nested ZIPs.

Members are the unit of parallelism: archives are cut into members first, by their directory, and each member is then
decompressed wherever it is dealt to. Everything after that is the same line-based plan as for plain files.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tempora.schemas import SOURCE_FILE
from tempora.session import materialise
from tempora.sources.tagged import POSITION, parse_tagged_lines

LINES_SCHEMA = "SOURCE_FILE string, line bigint, value string, error string"
BATCH_LINES = 50_000
CHUNK_BYTES = 1 << 18
NOT_VALID = "not a valid ZIP archive"
MEMBERS = pa.schema([("SOURCE_FILE", pa.string()), ("plain", pa.bool_()), ("crc", pa.int64()), ("data", pa.binary()), ("error", pa.string())])


def _members(archive: zipfile.ZipFile) -> list[str]:
    names = archive.namelist()
    return sorted(n for n in names if not n.endswith("/") and not n.startswith("__MACOSX"))


def _csv_streams(archive: zipfile.ZipFile, prefix: str) -> Iterator[tuple[str, zipfile.ZipFile, str]]:
    """(provenance, archive, member) of every CSV, entering nested archives one level deep."""
    for name in _members(archive):
        lowered = name.lower()
        if lowered.endswith(".csv"):
            yield f"{prefix}/{name}", archive, name
        elif lowered.endswith(".zip") and "/" not in prefix:
            try:
                inner = zipfile.ZipFile(io.BytesIO(archive.read(name)))
            except zipfile.BadZipFile as problem:
                raise zipfile.BadZipFile(f"{prefix}/{name}") from problem
            with inner:
                for member in _members(inner):
                    if member.lower().endswith(".csv"):
                        yield f"{prefix}/{name}/{member}", inner, member


def _local_data(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> bytes:
    """The stored bytes of a member, as they stand in the archive."""
    archive.fp.seek(info.header_offset)
    header = archive.fp.read(30)
    if header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile(info.filename)
    archive.fp.seek(sum(struct.unpack("<HH", header[26:30])), io.SEEK_CUR)
    return archive.fp.read(info.compress_size)


def _members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per CSV member, still compressed; one row with an error for an archive that cannot be read."""

    def row(source: str, plain: bool = True, crc: int | None = None, data: bytes = b"", error: str | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"SOURCE_FILE": source, "plain": plain, "crc": crc, "data": data, "error": error}], MEMBERS)

    for batch in batches:
        for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
            try:
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as outer:
                    for source, archive, member in _csv_streams(outer, name):
                        info = archive.getinfo(member)
                        known = info.compress_type in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) and not info.flag_bits & 1
                        if known:
                            yield row(source, info.compress_type == zipfile.ZIP_STORED, info.CRC, _local_data(archive, info))
                        else:  # rarer methods, and the error that an encrypted member raises
                            yield row(source, data=archive.read(info))
            except zipfile.BadZipFile as problem:
                inner = str(problem) if str(problem).startswith(f"{name}/") else name
                yield row(inner, error=NOT_VALID)


class _Inflated(io.RawIOBase):
    """A member's bytes, decompressed as they are read, with their checksum."""

    def __init__(self, data: bytes, plain: bool):
        self._rest, self._unpack, self._ready, self.crc = memoryview(data), None if plain else zlib.decompressobj(-zlib.MAX_WBITS), b"", 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self._ready and len(self._rest):
            part, self._rest = self._rest[:CHUNK_BYTES], self._rest[CHUNK_BYTES:]
            self._ready = bytes(part) if self._unpack is None else self._unpack.decompress(part)
            self.crc = zlib.crc32(self._ready, self.crc)
        n = min(len(buffer), len(self._ready))
        buffer[:n], self._ready = self._ready[:n], self._ready[n:]
        return n


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(source: str, first: int, lines: list[str], error: str | None = None) -> pa.RecordBatch:
        n = len(lines)
        columns = [pa.array([source] * n), pa.array(range(first, first + n), pa.int64()), pa.array(lines), pa.array([error] * n, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["SOURCE_FILE", "line", "value", "error"])

    for batch in batches:
        for member in batch.to_pylist():
            source = member["SOURCE_FILE"]
            if member["error"]:
                yield rows(source, 0, [""], member["error"])
                continue
            raw = _Inflated(member["data"], member["plain"])
            text = io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8-sig", errors="replace", newline=None)
            lines, first = [], 0
            try:
                for line in text:
                    lines.append(line.rstrip("\n"))
                    if len(lines) == BATCH_LINES:
                        yield rows(source, first, lines)
                        first, lines = first + len(lines), []
            except zlib.error:
                member["crc"] = -1
            if lines or first == 0:
                yield rows(source, first, lines or [""])
            if member["crc"] not in (None, raw.crc):
                yield rows(source, 0, [""], NOT_VALID)


def expand_archives(archives: DataFrame) -> DataFrame:
    """(name, content) -> lines, stored. ``content`` holds whole archives, ``name`` their file name.

    Archives are cut into their members without decompressing them; members are dealt over all tasks, where each is
    decompressed as it is read. One archive keeps as many tasks busy as it has members, and everything is expanded once.
    """
    members = archives.select("name", "content").mapInArrow(_members_of, "SOURCE_FILE string, plain boolean, crc bigint, data binary, error string")
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = members.repartition(tasks, SOURCE_FILE).mapInArrow(_lines_of, LINES_SCHEMA)
    return materialise(lines, "archive-lines").select(SOURCE_FILE, F.col("line").cast("decimal(38,0)").alias(POSITION), "value", "error")


def parse_archives(archives: DataFrame, eager: bool = False) -> DataFrame:
    """Data rows of all CSV members of the given archives; undecodable bytes are replaced."""
    return parse_tagged_lines(expand_archives(archives), eager=eager, split_lines=BATCH_LINES)


def read_archives(spark: SparkSession, path: str, eager: bool = False) -> DataFrame:
    """All ``.zip`` files (any letter case) directly below ``path``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]").load(path)
    return parse_archives(found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"), eager)
