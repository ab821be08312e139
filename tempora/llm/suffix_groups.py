"""Removal of repeated passages: every byte covered by a 200-byte string that also starts anywhere else.

A 200-byte window is filed under its anchor, the 80 bytes inside it with the smallest hash (the last, among equals), so
equal windows have equal anchors at equal places. Consecutive windows with one anchor occurrence form a context: the
anchor with up to 120 bytes on either side. Anchors that occur once cannot be part of a repeat. Contexts that occur as a
whole more than once are repeated throughout. The other contexts of an anchor are joined into one string, with the anchor
as a single letter, whose suffixes are sorted by linear grouping; equal windows are then neighbours.

Grouping construction: suffixes are grouped by their longest Lyndon prefix. Groups start as the first letters and are
processed from the highest down. Each member of a group points to the nearest position before it that is in a lower
group (its previous smaller one); the positions pointed at, told apart by how often, are split off their own groups
upwards. When all groups are processed each one's order follows from the order of lower suffixes, by walking the same
pointers: no ranks are renamed and nothing recurses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tempora.llm.common import map_batches, ship, slices, stored

WINDOW, ANCHOR = 200, 80
#: Letters beyond the bytes: the anchor, and the end of a context.
ANCHOR_LETTER, END_LETTER = chr(256), chr(257)
#: Contexts of one anchor whose suffixes are sorted in one task; the windows of a larger set are counted instead.
SORTED_CONTEXTS = 4096
CODES = np.random.default_rng(60).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0xD6E8FEB86659FD93
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of byte strings by place: the polynomial of the bytes' codes modulo 2^64."""

    def __init__(self, data: np.ndarray):
        power, inverse = (np.full(data.size, x, np.uint64) for x in (BASE, BASE_INVERSE))
        power[:1] = inverse[:1] = 1
        self.inverse = np.cumprod(inverse, out=inverse)
        self.sums = np.zeros(data.size + 1, np.uint64)
        np.cumsum(np.multiply(CODES[data], np.cumprod(power, out=power), out=power), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def keys(self, width: int) -> np.ndarray:
        """A cheaper hash of each ``width`` bytes, good in its leading bits."""
        n = self.inverse.size - width + 1
        out = self.sums[width:] - self.sums[:n]
        out *= self.inverse[:n]
        out *= np.uint64(0x9E3779B97F4A7C15)
        return out


def contexts(raw: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> dict[str, np.ndarray]:
    """Contexts of all texts: text number, first and last window start, anchor place, hashes of anchor and context."""
    names = ("text", "first", "last", "at", "anchor", "context")
    data = np.frombuffer(b"".join(raw), np.uint8)
    span = window - anchor + 1
    if data.size < window:
        return {n: np.zeros(0, np.uint64 if n in ("anchor", "context") else np.int64) for n in names}
    sizes = np.array([len(r) for r in raw], np.int64)
    rolling = Rolling(data)
    # Leading bits: the hash. Low bits: the place, turned round, so that the last of equal ones is least.
    low = np.uint64((1 << max(24, int(data.size).bit_length())) - 1)
    least = (rolling.keys(anchor) | low) - np.arange(data.size - anchor + 1, dtype=np.uint64)
    width = 1  # places that an entry stands for, doubled until they span a window
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (low - (least & low)).astype(np.int64)
    text = np.repeat(np.arange(sizes.size), sizes)[: at.size]
    begins = np.cumsum(sizes) - sizes
    starts = np.flatnonzero(begins[text] + sizes[text] - np.arange(at.size) >= window)
    if not starts.size:
        return contexts([], window, anchor)
    text, at = text[starts], at[starts]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(text) != 0)]))
    first, last = starts[new], starts[np.concatenate([new[1:], [starts.size]]) - 1]
    at, owner = at[new], text[new]
    context = mixed(rolling.of(first, last + window) + (at - first).astype(np.uint64))
    return dict(zip(names, (owner, first - begins[owner], last - begins[owner], at - begins[owner], rolling.of(at, at + anchor), context)))


def lyndon_groups(s: str) -> tuple[list[int], list[int], list[int]]:
    """Groups of the suffixes of ``s`` by their longest Lyndon prefix.

    Returns each position's group rank (0: lowest), each group's size by rank, and each position's previous smaller
    position (the nearest one before it in a lower group; -1 if there is none).
    """
    n = len(s)
    letters = sorted(set(s))
    first = {c: k for k, c in enumerate(letters)}
    of = [first[c] for c in s]
    members: list[set[int]] = [set() for _ in letters]
    for i, g in enumerate(of):
        members[g].add(i)
    above = list(range(1, len(letters))) + [-1]  # groups as a linked list, upwards and downwards
    below = list(range(-1, len(letters) - 1))
    done, previous = [False] * n, [-1] * n
    g = len(letters) - 1
    while g >= 0:
        group = members[g]
        if len(group) == 1:
            (i,) = group
            done[i] = True
            j = i - 1
            while j >= 0 and done[j]:
                j = previous[j]
            previous[i] = j
            moves = [[j]] if j >= 0 else ()
        else:
            times: dict[int, int] = {}
            for i in sorted(group):
                done[i] = True
                j = i - 1
                while j >= 0 and done[j]:
                    j = previous[j]
                previous[i] = j
                if j >= 0:
                    times[j] = times.get(j, 0) + 1
            parts: dict[tuple[int, int], list[int]] = {}
            for j, k in times.items():
                parts.setdefault((-k, of[j]), []).append(j)
            moves = [parts[key] for key in sorted(parts)]  # most often first, so that it ends up highest
        for part in moves:
            h = of[part[0]]
            home = members[h]
            if len(home) == len(part):
                continue
            home.difference_update(part)
            new, up = len(members), above[h]
            members.append(set(part))
            for j in part:
                of[j] = new
            above.append(up)
            below.append(h)
            above[h] = new
            if up >= 0:
                below[up] = new
        g = below[g]
    ranks, sizes, g = [0] * len(members), [], 0  # the first letter's group stays the lowest: splits go upwards
    while g >= 0:
        ranks[g] = len(sizes)
        sizes.append(len(members[g]))
        g = above[g]
    return [ranks[g] for g in of], sizes, previous


def suffix_array(s: str) -> list[int]:
    """Start places of the suffixes of ``s`` in order; a suffix sorts before the longer ones that begin with it."""
    n = len(s)
    if not n:
        return []
    of, sizes, previous = lyndon_groups(s)
    free, total = [], 0  # next free place of each group
    for size in sizes:
        free.append(total)
        total += size
    order, placed = [-1] * n, [False] * n
    # The empty suffix is lowest; each suffix, once its turn comes, places the chain of those that it precedes in text.
    for k in range(-1, n):
        j = (n if k < 0 else order[k]) - 1
        while j >= 0 and not placed[j]:
            placed[j] = True
            g = of[j]
            order[free[g]] = j
            free[g] += 1
            j = previous[j]
    return order


def repeated_starts(members: list[tuple[bytes, int, int]], window: int = WINDOW, anchor: int = ANCHOR) -> list[list[int]]:
    """For each context (bytes, anchor place, number of window starts) the starts whose window occurs in another one too."""
    pieces, owner, offset = [], [], 0
    starts: dict[int, tuple[int, int]] = {}
    length = window - anchor + 1  # letters of a window, the anchor being one
    for k, (content, at, count) in enumerate(members):
        text = content.decode("latin-1")
        piece = text[:at] + ANCHOR_LETTER + text[at + anchor :] + END_LETTER
        for r in range(count):
            starts[offset + r] = (k, r)
        pieces.append(piece)
        offset += len(piece)
    s = "".join(pieces)
    found: list[list[int]] = [[] for _ in members]
    before, joined = None, False
    for i in suffix_array(s):
        if i not in starts:
            continue
        same = before is not None and s[i : i + length] == s[before : before + length]
        if same:
            for x in (i,) if joined else (before, i):
                k, r = starts[x]
                found[k].append(r)
        before, joined = i, same
    return found


def packed_place(first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First window start, further starts and anchor place of a context in one number."""
    return (first << 16) | ((last - first) << 8) | (at - first)


def context_rows(keyed: DataFrame) -> DataFrame:
    """(id, twin, place, anchor, context) of every context of (id, twin, text)."""
    kind = keyed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            found = contexts([t.encode() for t in part.column("text").to_pylist()])
            owner = pa.array(found["text"])
            place = packed_place(found["first"], found["last"], found["at"])
            hashes = [pa.array(found[n].view(np.int64)) for n in ("anchor", "context")]
            yield pa.RecordBatch.from_arrays([part.column("id").take(owner), part.column("twin").take(owner), pa.array(place), *hashes], ["id", "twin", "place", "anchor", "context"])

    return map_batches(keyed, run, f"id {kind}, twin long, place long, anchor long, context long")


def cut_contexts(keyed: DataFrame, asked: DataFrame) -> DataFrame:
    """(anchor, n, n_contexts, id, twin, place, content): the bytes of the contexts in ``asked``, cut out of their texts."""
    kind = keyed.schema["id"].dataType.simpleString()
    lists = asked.groupBy(F.col("id").alias("of"), F.col("twin").alias("of_twin")).agg(F.collect_list(F.struct("anchor", "n", "n_contexts", "place")).alias("cuts"))
    joined = keyed.join(lists, F.col("id").eqNullSafe(F.col("of")) & (F.col("twin") == F.col("of_twin"))).select("id", "twin", "text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            lists = part.column("cuts")
            cuts, owner = lists.flatten(), np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            raw = [t.encode() for t in part.column("text").to_pylist()]
            places = cuts.field("place").to_numpy()
            ends = (places >> 16) + ((places >> 8) & 255) + WINDOW
            content = pa.array([raw[k][a:b] for k, a, b in zip(owner.tolist(), (places >> 16).tolist(), ends.tolist())], pa.binary())
            told = [cuts.field(n) for n in ("anchor", "n", "n_contexts")]
            yield pa.RecordBatch.from_arrays(
                [*told, part.column("id").take(pa.array(owner)), part.column("twin").take(pa.array(owner)), cuts.field("place"), content],
                ["anchor", "n", "n_contexts", "id", "twin", "place", "content"],
            )

    return map_batches(joined, run, f"anchor long, n long, n_contexts long, id {kind}, twin long, place long, content binary")


def sorted_spans(rows: DataFrame) -> DataFrame:
    """(id, twin, start, end) of the repeated windows of contexts that occur once, by the suffix arrays of their anchors.

    ``rows`` are dealt out by anchor and arrive in its order, so a task holds one anchor's contexts at a time.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def close() -> None:
            members = [(content, place & 255, ((place >> 8) & 255) + 1) for _, _, _, _, place, content in held]
            for (_, n, who, twin, place, _), starts in zip(held, repeated_starts(members)):
                if n == 1 and starts:
                    at = sorted(starts)
                    begin = last = at[0]
                    for r in [*at[1:], None]:
                        if r is None or r > last + WINDOW:
                            out.append((who, twin, (place >> 16) + begin, (place >> 16) + last + WINDOW))
                            begin = r
                        last = r
            held.clear()

        def told() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)
            out.clear()
            return batch

        names, types = ["id", "twin", "start", "end"], None
        for batch in batches:
            types = types or [batch.schema.field("id").type, pa.int64(), pa.int64(), pa.int64()]
            columns = [batch.column(n).to_pylist() for n in ("anchor", "n", "id", "twin", "place", "content")]
            for row in zip(*columns):
                if held and held[0][0] != row[0]:
                    close()
                held.append(row)
            if out:
                yield told()
        if held:
            close()
        if out:
            yield told()

    dealt = rows.select("anchor", "n", "id", "twin", "place", "content").repartition("anchor").sortWithinPartitions("anchor")
    return map_batches(dealt, run, f"id {kind}, twin long, start long, end long")


def counted_spans(rows: DataFrame) -> DataFrame:
    """As ``sorted_spans``, for anchors with very many contexts: each window is hashed, and hashes are counted in Spark."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            counts = ((place >> 8) & 255) + 1
            owner = np.repeat(np.arange(batch.num_rows), counts)
            r = np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)
            hashes = [Rolling(np.frombuffer(c.as_py(), np.uint8)).of(np.arange(n), np.arange(n) + WINDOW) for c, n in zip(batch.column("content"), counts.tolist())]
            picked = [batch.column(n).take(pa.array(owner)) for n in ("anchor", "n", "id", "twin")]
            window = np.concatenate(hashes).view(np.int64) if hashes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*picked, pa.array((place >> 16)[owner] + r), pa.array(window)], ["anchor", "n", "id", "twin", "start", "window"])

    windows = stored(map_batches(rows, run, f"anchor long, n long, id {kind}, twin long, start long, window long"), "windows")
    again = windows.groupBy("anchor", "window").agg(F.count("*").alias("times")).where("times > 1").select("anchor", "window")
    met = windows.where("n = 1").join(again, ["anchor", "window"])
    return met.select("id", "twin", "start", (F.col("start") + WINDOW).alias("end"))


def repeated_spans(keyed: DataFrame, most_sorted: int = SORTED_CONTEXTS) -> DataFrame:
    """(id, twin, start, end): byte spans whose union is what repeated windows cover, several rows a text."""
    found = context_rows(keyed)
    # Stored, so that the join below has plain exchanges on both sides and Spark can split a hot anchor.
    often = stored(found.groupBy(F.col("anchor").alias("again")).agg(F.count("*").alias("times")).where("times > 1").select("again"), "anchors")
    # Contexts are worked out twice, which costs less than a stored table of all of them.
    met = stored(found.join(often, F.col("anchor") == F.col("again"), "left_semi"), "contexts")
    kinds = met.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("place", "id", "twin")).alias("eg"))
    kinds = stored(kinds.select("anchor", "context", "n", "eg.*"), "context-kinds")
    several = kinds.groupBy(F.col("anchor").alias("of")).agg(F.count("*").alias("n_contexts"), F.count_if(F.col("n") == 1).alias("once"))
    open_kinds = kinds.join(several.where("n_contexts > 1 AND once > 0").drop("once"), F.col("anchor") == F.col("of")).drop("of")
    content = stored(cut_contexts(keyed, open_kinds), "context-bytes")
    whole = kinds.where("n > 1").select(F.col("anchor").alias("of"), F.col("context").alias("of_context"))
    first, further = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    full = met.join(whole, (F.col("anchor") == F.col("of")) & (F.col("context") == F.col("of_context")), "left_semi")
    full = full.select("id", "twin", first.alias("start"), (first + further + WINDOW).alias("end"))
    return full.unionByName(sorted_spans(content.where(F.col("n_contexts") <= most_sorted))).unionByName(counted_spans(content.where(F.col("n_contexts") > most_sorted)))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_sorted: int = SORTED_CONTEXTS, as_text: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with three more: ``repeat_bytes`` (size of the text), ``repeat_spans`` (array of start
    and end, the maximal runs that were removed) and ``repeat_kept`` (binary, the bytes that are left).

    A byte goes if it lies in a 200-byte string that also starts elsewhere, in the same text or another, overlaps included;
    strings are judged on the input. Null texts are empty; texts under 200 bytes keep everything. Repeated rows are texts
    each, so they lose all if they have 200 bytes. Strings never cross texts. Cuts ignore character borders.
    ``as_text``: instead of ``repeat_kept``, ``repeat_text`` has those bytes as text, without characters that were cut in two.
    Anchors with more than ``most_sorted`` different contexts are decided by counting windows, with the same result.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    twin = F.xxhash64(text)
    every = docs.select(F.col(id_col).alias("id"), twin.alias("twin"), text.alias("text")).where(F.octet_length(text) >= WINDOW)
    # Rows that repeat both id and text lose all; one of them stands for the others, so that contexts and spans do not multiply.
    again = every.groupBy("id", "twin").agg(F.count("*").alias("copies"), F.max(F.octet_length("text")).alias("bytes")).where("copies > 1")
    again = stored(again.select(F.col("id").alias("again"), F.col("twin").alias("again_twin"), F.col("bytes").cast("long").alias("bytes")), "repeated-rows")
    repeated = F.col("id").eqNullSafe(F.col("again")) & (F.col("twin") == F.col("again_twin"))
    example = every.join(again, repeated, "left_semi").groupBy("id", "twin").agg(F.min("text").alias("text"))
    keyed = every.join(again, repeated, "left_anti").unionByName(stored(example, "repeated-texts"))
    spans = repeated_spans(keyed, most_sorted).join(again, repeated, "left_anti")
    spans = spans.unionByName(again.select(F.col("again").alias("id"), F.col("again_twin").alias("twin"), F.lit(0).cast("long").alias("start"), F.col("bytes").alias("end")))
    lists = spans.groupBy(F.col("id").alias("__of"), F.col("twin").alias("__of_twin")).agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    lists = stored(lists, "spans")
    names = docs.columns
    joined = docs.withColumn("__twin", twin).join(lists, F.col(id_col).eqNullSafe(F.col("__of")) & (F.col("__twin") == F.col("__of_twin")), "left")
    joined = joined.select(*[F.col(c) for c in names], "__spans")

    added = T.StructType.fromDDL("repeat_bytes bigint, repeat_spans array<struct<start:bigint,end:bigint>>, " + ("repeat_text string" if as_text else "repeat_kept binary"))
    out = T.StructType([*docs.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            sizes, merged, kept = [], [], []
            for t, spans in zip(part.column(text_col).to_pylist(), part.column("__spans").to_pylist()):
                raw, runs, left, at = (t or "").encode(), [], [], 0
                for span in sorted((s["start"], s["end"]) for s in spans or ()):
                    if runs and span[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span[1])
                    else:
                        runs.append(list(span))
                for start, end in runs:
                    left.append(raw[at:start])
                    at = end
                sizes.append(len(raw))
                merged.append([{"start": a, "end": b} for a, b in runs])
                left = b"".join([*left, raw[at:]])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            added = [pa.array(sizes, pa.int64()), pa.array(merged, spans_type), pa.array(kept, pa.string() if as_text else pa.binary())]
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(names))), *added], out.names)

    return map_batches(joined, run, out)
