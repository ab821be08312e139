"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked id pairs by external spill counting.

Each text is encoded by a byte-level vocabulary (side A) and a piece model (side B). Byte offsets at which tokens of both
sides end cut them into groups; the two tokens that end there are linked. Counting works as an external sort does:

* a slice of texts turns its links into (pair, document, times) records, orders them by side B's id, then side A's, and
  splits them by the radix digit of side B's id into runs compressed with zstd;
* the runs of a digit are dealt over as many parts as their bytes need, whatever share of the links a token holds. In a part
  a heap merges the runs' pairs, read block by block, and adds up each pair; Spark adds up the parts;
* the totals go back to the parts in the order of side B, so that each id's maximum is known before its runs are
  read again, and what each document's links count streams back to it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tempora.llm.common import ship, slices, stored

#: Digits of side B's ids; the runs of one digit are split further by their bytes.
RADIX = 32
#: Compressed bytes of runs that one part merges.
PART_BYTES = 32 << 20
#: Texts of a slice: bytes that are encoded, ordered and split at once.
SLICE_BYTES = 2 << 20
#: Longer runs of white space are encoded by the slower library, as the faster one's pattern has no room for them.
LONG_SPACE = regex.compile(r"\s{2000}")
#: Entries that a run hands to the merge at a time.
BLOCK = 1 << 13


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both vocabularies: encoders, each id's bytes and their lengths."""

    def __init__(self, byte_json: str, piece_model: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(byte_json)
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        chars = byte_characters()
        names = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = name.encode() if name in special else bytes(chars[c] for c in name)
        self.byte_json = byte_json
        # Merges come in the order of ids, so ids are ranks; README of the vocabularies gives the pattern.
        import public_tokenizers

        ranks = {self.a_bytes[i]: i for name, i in names.items() if name not in special}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        n = self.pieces.get_piece_size()
        piece = self.pieces.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.pieces.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(n)]
        self.a_size, self.b_size = len(self.a_bytes), n
        if self.a_size * n >= 1 << 31:
            raise ValueError("the sizes of the vocabularies multiply to 2^31 or more")
        self.a_len, self.b_len = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        ends = [[f"{i}{mark}" for i in range(size) for mark in marks] for size, marks in ((self.a_size, ",|"), (n, ",;"))]
        self.written = np.array(ends[0] + ends[1], object)

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        slow = Tokenizer.from_str(self.byte_json)
        slow.encode_special_tokens = True  # their strings are plain text
        return slow

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both sides, or None if either side's bytes are not space + text."""
        if not text:
            return None
        spaced = " " + text
        if LONG_SPACE.search(spaced):
            a = self.slow.encode(spaced, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(spaced)
        b = self.pieces.encode(text, num_threads=1)
        raw = spaced.encode()
        same = b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw
        return (a, b) if same else None


@lru_cache(maxsize=1)
def tokenizers_of(byte_json: str, piece_model: bytes) -> Tokenizers:
    return Tokenizers(byte_json, piece_model)


def aligned_slice(texts: list[str | None], both: Tokenizers) -> dict[str, np.ndarray | list[str]]:
    """n_a, n_b, n_groups of each text, their written groups, and the links as (text, side B id * side A size + side A id)."""
    coded = [both.encode(t) if t else None for t in texts]
    a_n, b_n = (np.array([len(c[side]) if c else 0 for c in coded], np.int64) for side in (0, 1))
    a, b = (np.fromiter((i for c in coded if c for i in c[side]), np.int64, n.sum()) for side, n in ((0, a_n), (1, b_n)))
    a_end, b_end = np.cumsum(both.a_len[a]), np.cumsum(both.b_len[b])
    total = int(a_end[-1]) if a.size else 0
    a_at, b_at = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    a_at[a_end], b_at[b_end] = True, True
    a_last, b_last = b_at[a_end], a_at[b_end]  # a text's last tokens always are, so groups lie within a text
    a_ends, b_ends = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1  # by group
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    b_starts = np.concatenate([[0], b_ends[:-1]])[: b_ends.size]
    codes = np.empty(a.size + b.size, np.int64)
    codes[np.arange(a.size) + b_starts[a_group]] = 2 * a + a_last
    codes[np.arange(b.size) + a_ends[b_group]] = 2 * both.a_size + 2 * b + b_last
    written = both.written[codes].tolist()
    cuts = np.concatenate([[0], np.cumsum(a_n + b_n)]).tolist()
    groups = ["".join(written[s:e])[:-1] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    text = np.searchsorted(np.cumsum(a_n), a_ends, side="left")  # of each link
    n_groups = np.bincount(text, minlength=len(texts))
    return {"n_a": a_n, "n_b": b_n, "n_groups": n_groups, "groups": groups, "text": text, "pair": b[b_ends - 1] * both.a_size + a[a_ends - 1]}


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers, each behind its length, as one zstd frame."""
    parts = [np.array([x.size], np.uint32).tobytes() + x.astype(np.uint32).tobytes() for x in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueezed(frame: bytes) -> list[np.ndarray]:
    data, out, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint32), [], 0
    while at < data.size:
        n = int(data[at])
        out.append(data[at + 1 : at + 1 + n].astype(np.int64))
        at += 1 + n
    return out


def spilled(text: np.ndarray, pair: np.ndarray, a_size: int) -> list[dict[str, object]]:
    """The links of a slice as runs, one for each radix digit that has any: ``head`` has (pair, times) interleaved in order,
    ``body`` the documents of each pair, their numbers and times."""
    width = np.int64(max(1, int(text.max(initial=0)) + 1))
    key, times = np.unique(pair * width + text, return_counts=True)
    pair, text = key // width, key % width
    digit = (pair // a_size) % RADIX
    runs = []
    for d in np.unique(digit):
        mine = np.flatnonzero(digit == d)
        first = np.flatnonzero(np.diff(pair[mine], prepend=-1))
        sums = np.add.reduceat(times[mine], first)
        head = np.stack([pair[mine][first], sums], axis=1).astype(np.uint32)
        body = squeezed(np.diff(np.append(first, mine.size)), text[mine], times[mine])
        runs.append({"digit": int(d), "head": zstandard.ZstdCompressor(level=1).compress(head.tobytes()), "body": body})
    return runs


ALIGNED = "doc_key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, runs array<struct<digit:int,head:binary,body:binary>>"
RUNS = pa.list_(pa.struct([("digit", pa.int32()), ("head", pa.binary()), ("body", pa.binary())]))


def align_texts(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """One row a row of ``docs``: doc_key (unique), doc_id, n_a, n_b, n_groups, n_links, the written ``groups``, and on the
    first row of a slice its ``runs`` of records.

    Null and empty texts, and texts that a side does not give back as space + text, have zeros and empty groups. Ids may be
    null or repeat; other columns are not read. Store the result before it is read twice: keys belong to one run.
    """
    spark = docs.sparkSession
    ship(spark)
    # Vocabularies are bounded: two files of a few MB, read on the driver once.
    files = spark.sparkContext.broadcast((Path(byte_vocabulary).read_text(encoding="utf-8"), Path(piece_model).read_bytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(*files.value)
        at = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text", SLICE_BYTES):
            if not part.num_rows:
                continue
            got = aligned_slice(part.column("text").to_pylist(), both)
            runs = [spilled(got["text"], got["pair"], both.a_size)] + [None] * (part.num_rows - 1)
            longs = [pa.array(x, pa.int64()) for x in (np.arange(at, at + part.num_rows), got["n_a"], got["n_b"], got["n_groups"], got["n_groups"])]
            yield pa.RecordBatch.from_arrays(
                [longs[0], part.column("doc_id"), *longs[1:], pa.array(got["groups"], pa.string()), pa.array(runs, RUNS)],
                ["doc_key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "runs"],
            )
            at += part.num_rows

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def entries(frame: bytes) -> Iterator[int]:
    """(pair << 32 | times) of a run's head in order, unpacked block by block."""
    with zstandard.ZstdDecompressor().stream_reader(frame) as reader:
        while block := reader.read(8 * BLOCK):
            while len(block) % 8:
                block += reader.read(8 - len(block) % 8)
            pairs = np.frombuffer(block, np.uint32).reshape(-1, 2).astype(np.int64)
            yield from ((pairs[:, 0] << 32) | pairs[:, 1]).tolist()


def merged(frames: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (pair, times) over all runs: every pair once, in order."""
    stream, pair, times = heapq.merge(*map(entries, frames)), np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        block = np.fromiter(islice(stream, 1 << 18), np.int64)
        pair, times = np.concatenate([pair, block >> 32]), np.concatenate([times, block & 0xFFFFFFFF])
        if not pair.size:
            return
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        pair, times = pair[first], np.add.reduceat(times, first)
        kept = 0 if not block.size else 1  # the last pair may go on in the next block
        yield pair[: pair.size - kept], times[: pair.size - kept]
        pair, times = pair[pair.size - kept :], times[times.size - kept :]


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of batches in which ``part`` is one number; rows come in its order."""
    for batch in batches:
        part = batch.column("part").to_numpy(zero_copy_only=False)
        cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), part.size]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(part[s]), batch.slice(s, e - s)


def pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(part: int, frames: list[bytes]) -> Iterator[pa.RecordBatch]:
        for pair, times in merged(frames):
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(times)], ["pair", "times"])

    now, frames = None, []
    for part, rows in by_part(batches):
        if part != now:
            yield from counted(now, frames)
            now, frames = part, []
        frames += rows.column("head").to_pylist()
    yield from counted(now, frames)


def contributions(a_size: int):
    """Totals of a part's pairs, in the order of side B, then its runs: what each document's links count, run by run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pairs, totals, best = None, [], [], None
        for part, rows in by_part(batches):
            if part != now:
                now, pairs, totals, best = part, [], [], None
            heads = rows.column("head")
            n = heads.null_count  # totals come first
            if n:
                pairs.append(rows.column("pair").to_numpy(zero_copy_only=False)[:n].astype(np.int64))
                totals.append(rows.column("times").to_numpy(zero_copy_only=False)[:n].astype(np.int64))
            for i in range(n, rows.num_rows):
                if best is None:
                    pair, total = np.concatenate(pairs), np.concatenate(totals)
                    side = pair // a_size
                    first = np.flatnonzero(np.diff(side, prepend=-1))
                    most = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, pair.size)))
                    best = total == most
                head = np.frombuffer(zstandard.ZstdDecompressor().decompress(heads[i].as_py()), np.uint32).reshape(-1, 2)[:, 0].astype(np.int64)
                per_pair, text, times = unsqueezed(rows.column("body")[i].as_py())
                place = np.repeat(np.searchsorted(pair, head), per_pair)
                n_best, total_of = np.zeros((2, int(text.max()) + 1), np.int64)
                np.add.at(n_best, text, times * best[place])
                np.add.at(total_of, text, times * total[place])
                has = np.unique(text)
                keys = pa.array(rows.column("doc_key")[i].as_py() + has)
                yield pa.RecordBatch.from_arrays([keys, pa.array(n_best[has]), pa.array(total_of[has])], ["doc_key", "n_best", "count_sum"])

    return run


def with_pair_counts(aligned: DataFrame, a_size: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of a stored ``align_texts`` without their runs, with n_best and count_sum.

    n_best: links whose pair has the largest count of all pairs of its side B id, ties included. count_sum: the links'
    counts added up. An empty table stays empty.
    """
    spilt = aligned.where(F.col("runs").isNotNull()).select("doc_key", F.explode("runs").alias("run"))
    bytes_of = {r["digit"]: r["n"] for r in spilt.groupBy("run.digit").agg(F.sum(F.length("run.head") + F.length("run.body")).alias("n")).collect()}  # RADIX rows at most
    parts = F.array(*(F.lit(max(1, -(-bytes_of.get(d, 0) // part_bytes))) for d in range(RADIX)))
    of_digit = lambda digit: F.element_at(parts, digit + 1)
    numbered = lambda digit, salt: (digit + RADIX * salt).cast("long")
    runs = spilt.select("doc_key", "run.*").withColumn("part", numbered(F.col("digit"), F.pmod(F.xxhash64("doc_key"), of_digit(F.col("digit")))))
    dealt = runs.select("part", "head").repartition("part").sortWithinPartitions("part")
    partial = dealt.mapInArrow(pair_counts, "pair long, times long")
    totals = stored(partial.groupBy("pair").agg(F.sum("times").alias("times")), "pair-totals")
    digit = (F.floor(F.col("pair") / a_size) % RADIX).cast("int")
    salted = totals.select(F.explode(F.sequence(F.lit(0), of_digit(digit) - 1)).alias("salt"), "pair", "times")
    nothing = F.lit(None)
    rows = salted.select(numbered(digit, F.col("salt")).alias("part"), "pair", "times", nothing.cast("long").alias("doc_key"), nothing.cast("binary").alias("head"), nothing.cast("binary").alias("body"))
    rows = rows.unionByName(runs.select("part", nothing.cast("long").alias("pair"), nothing.cast("long").alias("times"), "doc_key", "head", "body"))
    ordered = rows.repartition("part").sortWithinPartitions("part", F.col("pair").asc_nulls_last())
    back = ordered.mapInArrow(contributions(a_size), "doc_key long, n_best long, count_sum long")
    sums = back.groupBy("doc_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    return aligned.drop("runs").join(sums, "doc_key", "left").withColumns(none).drop("doc_key")


def vocabulary_size(byte_vocabulary: str) -> int:
    return max(json.loads(Path(byte_vocabulary).read_text(encoding="utf-8"))["model"]["vocab"].values()) + 1


def align_tokenizers(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """``align_texts``, stored, with counts: doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum."""
    return with_pair_counts(stored(align_texts(docs, byte_vocabulary, piece_model), "aligned"), vocabulary_size(byte_vocabulary))
