"""Benchmark decontamination by suffix arrays over the training texts.

A shard is a slice of documents. Its words become numbers, and a suffix array orders the word positions by the words that
follow, to the depth of a window at least. Every suffix of the benchmark is searched in every shard's array at once: each
further word narrows its range by binary search, until the range is empty or the window is whole. The ranges are the
locations; windows that follow one another in both texts make up one verbatim match, as long as it goes, and matches are
compared byte by byte. Matches come back with the documents' rows, so nothing of the documents is shuffled.

The benchmark is cut into blocks of bounded size. Each block is broadcast for one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from tempora.llm.common import ship, slices, stored

WINDOW_WORDS = 10
#: Texts of a shard in bytes; a longer text is a shard of its own.
SHARD_BYTES = 4 << 20
#: Words of the benchmark that are broadcast at a time, and of a piece of a long item.
BLOCK_WORDS, PIECE_WORDS = 1 << 20, 1 << 16
#: Words of an item, as a Java pattern: every character that is not ASCII counts as part of a word.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
CODES = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 5


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


@dataclass
class Words:
    """The words of texts that lie in one buffer, in lower case."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray  # of each word
    first: np.ndarray  # word of each text, and the number of words at the end

    def bytes_of(self, start: int, end: int) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[start:end], self.ends[start:end], strict=True))


def words_of(raw: list[bytes]) -> Words:
    data = LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    inside = WORD_BYTE[data]
    edges = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    # Hashes of words from differences of one running sum, brought to a common power by the inverse of the base.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(CODES[data] * powers(BASE, data.size), dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * powers(pow(BASE, -1, 1 << 64), data.size)[starts]
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    first = np.searchsorted(text, np.arange(len(raw) + 1))
    return Words(data, starts, ends, hashes, text, first)


class Benchmark:
    """A block of pieces of items: the distinct suffixes to search, and where each of them stands."""

    def __init__(self, pieces: list[tuple[str | None, int, int, str]], window: int):
        """``pieces``: (item id, words of the item, place of the piece in it, the piece's words with spaces between them)."""
        self.words = words_of([p[3].encode() for p in pieces])
        w = self.words
        self.dictionary = np.unique(w.hashes)
        ids = np.append(np.searchsorted(self.dictionary, w.hashes) + 1, np.zeros(window, np.int64))
        # Pieces with the same words are one class.
        shape: dict[tuple[bytes, int, bool], int] = {}
        self.members: list[list[tuple[str | None, int]]] = []
        rows, self.class_first, self.lengths = [], [], []
        for k, (item, total, place, _) in enumerate(pieces):
            s, e = int(w.first[k]), int(w.first[k + 1])
            c = shape.setdefault((ids[s:e].tobytes(), e - s, total < window), len(shape))
            if c == len(self.members):
                self.members.append([])
                self.class_first.append(s)
                depth = total if total < window else window
                rows += [(depth, c, j, s + j) for j in range(e - s - depth + 1)]
            self.members[c].append((item, place))
        depth, self.of_class, self.offset, at = np.array(rows, np.int64).reshape(-1, 4).T
        suffix = np.where(np.arange(window) < depth[:, None], ids[at[:, None] + np.arange(window)], 0)
        self.suffixes, which = np.unique(suffix, axis=0, return_inverse=True)
        self.depth = (self.suffixes > 0).sum(axis=1)
        self.places = np.argsort(which.ravel(), kind="stable")  # of (class, offset), suffix by suffix
        self.place_from = np.searchsorted(which.ravel()[self.places], np.arange(len(self.suffixes) + 1))
        self.class_first = np.array(self.class_first, np.int64)
        for m in self.members:
            m.sort(key=lambda x: (x[0] is None, x[0] or "", x[1]))
        self.names = [sorted({i for i, _ in m if i is not None}) for m in self.members]


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions whose number is not 0, ordered by the ``depth`` numbers from there on, at least. ``ids`` ends with ``depth`` zeros."""
    bits = max(1, int(ids.max(initial=0)).bit_length())
    at, held = np.flatnonzero(ids), max(1, min(depth, 62 // bits))
    key = np.zeros(at.size, np.int64)
    for j in range(held):
        key = (key << bits) | ids[np.minimum(at + j, ids.size - 1)]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.diff(key[order], prepend=-1) != 0
        if held >= depth or new.all():
            return at[order]
        rank = np.zeros(ids.size, np.int64)
        rank[at[order]] = np.cumsum(new)
        key = rank[at] * np.int64(at.size + 1) + rank[np.minimum(at + held, ids.size - 1)]
        held *= 2


def locate(ids: np.ndarray, array: np.ndarray, suffixes: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range [low, high) of the suffix array whose positions begin with all ``depth`` words of each suffix."""
    low, high = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), array.size, np.int64)
    for k in range(suffixes.shape[1]):
        live = np.flatnonzero((low < high) & (k < depth))
        want = suffixes[live, k]
        ends = []
        for right in (False, True):
            a, b = low[live], high[live]
            while (open_ := a < b).any():
                mid = (a + b) // 2
                seen = ids[array[np.minimum(mid, array.size - 1)] + k]
                below = open_ & ((seen <= want) if right else (seen < want))
                a, b = np.where(below, mid + 1, a), np.where(open_ & ~below, mid, b)
            ends.append(a)
        low[live], high[live] = ends
    return low, high


def spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [start, end), and the range of each."""
    n = end - start
    owner = np.repeat(np.arange(n.size), n)
    return np.arange(owner.size) - np.repeat(np.cumsum(n) - n, n) + start[owner], owner


def search(w: Words, bench: Benchmark) -> np.ndarray:
    """Verbatim matches of a shard: rows (text, class, start in the piece, start in the text, words), as long as they go."""
    none = np.zeros((0, 5), np.int64)
    window = bench.suffixes.shape[1]
    if not w.hashes.size or not bench.dictionary.size:
        return none
    place = np.minimum(np.searchsorted(bench.dictionary, w.hashes), bench.dictionary.size - 1)
    known = np.where(bench.dictionary[place] == w.hashes, place + 1, 0)
    ids = np.zeros(w.hashes.size + w.first.size + window, np.int64)  # with a 0 behind each text
    ids[np.arange(w.hashes.size) + w.text] = known
    low, high = locate(ids, array := suffix_array(ids, window), bench.suffixes, bench.depth)
    hit, suffix = spread(low, high)
    if not hit.size:
        return none
    spot = array[hit]
    text = np.searchsorted(w.first[:-1] + np.arange(w.first.size - 1), spot, side="right") - 1
    start = spot - text - w.first[text]
    # Each location with each place of its suffix in the items' classes; rows of a diagonal that follow one another join.
    row, of = spread(bench.place_from[suffix], bench.place_from[suffix + 1])
    row = bench.places[row]
    text, start, length = text[of], start[of], bench.depth[suffix][of]
    kind, offset = bench.of_class[row], bench.offset[row]
    order = np.lexsort((start, start - offset, kind, text))
    text, start, length, kind, offset = (x[order] for x in (text, start, length, kind, offset))
    joins = (np.diff(text) == 0) & (np.diff(kind) == 0) & (np.diff(start - offset) == 0) & (np.diff(start) == 1)
    head = np.flatnonzero(np.concatenate([[True], ~joins]))
    last = np.append(head[1:], text.size) - 1
    found = np.stack([text[head], kind[head], offset[head], start[head], start[last] + length[last] - start[head]], axis=1)
    return np.concatenate([none, *(confirmed(w, bench, m) for m in found.tolist())])


def confirmed(w: Words, bench: Benchmark, match: list[int]) -> np.ndarray:
    """The match, if its words' bytes agree; where equal hashes stood for different words, the parts of it that hold a window."""
    text, kind, offset, start, n = match
    a, b = int(w.first[text]) + start, int(bench.class_first[kind]) + offset
    if w.bytes_of(a, a + n) == bench.words.bytes_of(b, b + n):
        return np.array([match], np.int64)
    same = np.array([w.bytes_of(a + i, a + i + 1) == bench.words.bytes_of(b + i, b + i + 1) for i in range(n)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
    least = min(n, bench.suffixes.shape[1])  # a shorter match is a whole short item
    return np.array([(text, kind, offset + s, start + s, e - s) for s, e in edges if e - s >= least], np.int64).reshape(-1, 5)


MATCHES = ArrayType(StructType([StructField("item_id", StringType()), *(StructField(c, LongType()) for c in ("item_start", "start", "words"))]))
SPANS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "end")]))
ADDED = [StructField("leak_words", LongType()), StructField("leak_matches", MATCHES), StructField("leak_spans", SPANS), StructField("leak_items", ArrayType(StringType()))]


def spans_of(ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Ranges of words joined where they overlap or touch."""
    out: list[dict[str, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], e)
        else:
            out.append({"start": s, "end": e})
    return out


def found_in(w: Words, bench: Benchmark, texts: int) -> dict[str, list]:
    """The added columns of a shard's texts."""
    counts = np.diff(w.first)
    matches, spans, items = ([[] for _ in range(texts)] for _ in range(3))
    rows = search(w, bench)
    cuts = [*np.flatnonzero(np.diff(rows[:, 0], prepend=-1)).tolist(), len(rows)]
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        k, mine = int(rows[s, 0]), rows[s:e].tolist()
        for _, kind, offset, start, n in mine:
            item, place = bench.members[kind][0]
            matches[k].append({"item_id": item, "item_start": place + offset, "start": start, "words": n})
        spans[k] = spans_of([(start, start + n) for _, _, _, start, n in mine])
        items[k] = sorted({name for kind in {m[1] for m in mine} for name in bench.names[kind]})
    return {"leak_words": counts.tolist(), "leak_matches": matches, "leak_spans": spans, "leak_items": items}


def pieces_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, total, place, piece) of the items with words: long items in pieces that overlap by all but one word of a window."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = benchmark.select(F.col("item_id").cast("string").alias("item"), F.regexp_extract_all(lower, F.lit(WORD), 0).alias("w"))
    split = split.withColumn("total", F.size("w").cast("long")).where(F.col("total") > 0)
    places = split.withColumn("place", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("total") - window).cast("int"), F.lit(PIECE_WORDS))))
    return places.select("item", "total", F.col("place").cast("long"), F.array_join(F.slice("w", F.col("place") + 1, PIECE_WORDS + window - 1), " ").alias("piece"))


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[str | None, int, int, str]]]:
    """Pieces in blocks of about ``block_words`` words; the driver holds one block at a time."""
    pieces = stored(pieces_of(benchmark, window), "benchmark-pieces")
    words = pieces.agg(F.sum(F.size(F.split("piece", " ")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    placed = pieces.withColumn("block", F.pmod(F.xxhash64("item", "place", "piece"), blocks))
    for k in range(blocks):
        yield [tuple(r) for r in placed.where(F.col("block") == k).drop("block").orderBy("item", "place", "piece").collect()]


def with_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with leak_words (words of the text), leak_matches, leak_spans (words that matches cover) and leak_items.

    A match is a verbatim run of words that holds a window of ``window`` words of an item, or a whole shorter item, as
    long as it goes; items with the same words are named by their smallest id in leak_matches, and all of them in leak_items
    (distinct, ordered as text). Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case.
    Null and empty texts have no words. Items without words match nothing; one without an id matches and is not named.
    Repeated documents are judged alike. Columns of the added names are refused.
    """
    spark = docs.sparkSession
    if taken := {f.name for f in ADDED} & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(taken)}")
    ship(spark)
    columns = docs.columns
    out = StructType([*docs.schema.fields, *ADDED])
    types = to_arrow_schema(StructType(ADDED))
    done = None
    for pieces in item_blocks(benchmark, window, block_words):
        done = one_block(docs if done is None else stored(done, "decontaminated"), columns, pieces, window, out, types)
    return done


def one_block(docs: DataFrame, columns: list[str], pieces: list, window: int, out: StructType, types: pa.Schema) -> DataFrame:
    block = docs.sparkSession.sparkContext.broadcast(pieces)  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(block.value, window)
        for part in slices(batches, "text", SHARD_BYTES):
            if not part.num_rows:
                continue
            raw = [t.encode() if t else b"" for t in part.column("text").to_pylist()]
            got = found_in(words_of(raw), bench, part.num_rows)
            if part.num_columns > len(columns):  # what other blocks have found
                for name in ("leak_matches", "leak_items"):
                    old = part.column(name).to_pylist()
                    got[name] = [a + b if name == "leak_matches" else sorted({*a, *b}) for a, b in zip(old, got[name], strict=True)]
                got["leak_spans"] = [spans_of([(m["start"], m["start"] + m["words"]) for m in ms]) for ms in got["leak_matches"]]
            arrays = [part.column(c) for c in columns] + [pa.array(got[f.name], f.type) for f in types]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *types.names])

    return docs.mapInArrow(run, out)


def is_clean() -> Column:
    return F.size("leak_spans") == 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` without a word of a benchmark window, with their own columns."""
    return with_matches(docs, benchmark, **options).where(is_clean()).select(*docs.columns)
