"""Near-duplicates by BagMinHash: weighted Jaccard similarity of the multisets of five-word shingles.

Every distinct shingle with weight w owns a strip [0, w) x time of a Poisson process. The strip is cut hierarchically at
1, 2, 4, ...: each piece is a process of its own with a rate equal to its width, whose points, in the order of time, carry a
register and a unit cell; points in cells beyond w are thinned out. A register keeps its earliest point, so two multisets
agree in a register with a probability equal to their weighted Jaccard similarity. A process stops as soon as its next
point is later than every register of its document, so most shingles need one or two points.

Signatures are cut into bands. Documents that share a band are compared with pivots of their bucket, by the exact
overlap of their multisets, until each bucket's documents are in one class or all compared. After the first pivots, pairs
whose multisets cannot overlap enough are left out: shingles that no other undecided document has count for nothing, and
the others are counted in groups, so that the sum of the groups' lesser counts bounds the overlap from above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tempora.llm.common import map_batches, ship, slices, stored

SHINGLE_WORDS = 5
#: A pair is similar from this many hundredths on.
PERCENT = 80
#: 40 bands of 7 registers: a pair at 0.8 is missed with a probability of (1 - 0.8^7)^40 < 1e-4, one at 0.85 of 1e-6.
BANDS, BAND_ROWS = 40, 7
#: Buckets of at most this many distinct texts are compared in full; larger ones by pivots, so many times as many each round.
FULL_BUCKET, GROWTH = 8, 16
#: The first round looks at so many bands only: most near copies join there and need no comparison in the others.
FIRST_BANDS = 4
#: From this round on, overlaps are bounded before pairs are made, by the counts of so many groups of shingles.
BOUND_ROUND, GROUPS = 2, 16
#: Candidates that agree in fewer registers than this many standard deviations below the mean at the limit are not read.
DEVIATIONS = 5
HASH_BITS = 44
MASK = np.uint64((1 << HASH_BITS) - 1)
BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def shingles(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (text << 44 | shingle hash) of all texts' distinct shingles, and how often each occurs.

    Words are runs without ASCII white space. A text of one to four words has one shingle, all its words.
    """
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    ends = ends[: starts.size]
    n = data.size
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[data] * powers(BASE, n), dtype=np.uint64)])
    words = mixed((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    counts = np.bincount(text, minlength=len(raw))
    first = np.cumsum(counts) - counts
    width, prime = SHINGLE_WORDS, np.uint64(0x100000001B3)
    keys = []
    if words.size >= width:
        rolled = np.zeros(words.size - width + 1, np.uint64)
        for j in range(width):
            rolled = rolled * prime + words[j : words.size - width + 1 + j]
        inside = text[: rolled.size] == text[width - 1 :]
        keys.append((text[: rolled.size][inside].astype(np.uint64) << np.uint64(HASH_BITS)) | (mixed(rolled[inside]) & MASK))
    short = np.flatnonzero((counts > 0) & (counts < width))
    if short.size:
        value = np.zeros(short.size, np.uint64)
        for j in range(width - 1):
            has = counts[short] > j
            value = np.where(has, value * prime + words[np.minimum(first[short] + j, words.size - 1)], value)
        keys.append((short.astype(np.uint64) << np.uint64(HASH_BITS)) | (mixed(value + counts[short].astype(np.uint64)) & MASK))
    return np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)


def signatures(keys: np.ndarray, weights: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """texts x registers matrix of the earliest point times; infinite for a text without shingles."""
    best = np.full(texts * registers, np.inf)
    owner, item = (keys >> np.uint64(HASH_BITS)).astype(np.int64), keys & MASK
    seeds, rates, lows, limits, owners = [], [], [], [], []
    level, low, width = 0, 0, 1
    while owner.size:  # the pieces [0, 1), [1, 2), [2, 4), ... that begin below the weight
        seeds.append(mixed(item + np.uint64(level << HASH_BITS)))
        owners.append(owner)
        limits.append(weights)
        rates.append(np.full(owner.size, float(width)))
        lows.append(np.full(owner.size, low, np.int64))
        level, low, width = level + 1, low + width, low + width
        more = weights > low
        owner, item, weights = owner[more], item[more], weights[more]
    if not seeds:
        return best.reshape(texts, registers)
    seed, rate, low, limit, owner = (np.concatenate(x) for x in (seeds, rates, lows, limits, owners))
    time, step, limits = np.zeros(seed.size), 0, np.full(texts, np.inf)
    unit = 2.0**-53
    while seed.size:
        step += 1
        draw = mixed(seed + np.uint64((step * 0xD1342543DE82EF95) & ((1 << 64) - 1)))
        time = time - np.log((draw >> np.uint64(11)).astype(np.float64) * unit + unit / 2) / rate
        spot = mixed(draw + np.uint64(0x2545F4914F6CDD1D))
        register = (spot & np.uint64(0xFFFFFFFF)) % np.uint64(registers)
        cell = low + ((spot >> np.uint64(32)).astype(np.float64) * 2.0**-32 * rate).astype(np.int64)
        hit = (cell < limit) & (time < limits[owner])
        np.minimum.at(best, owner[hit] * registers + register[hit].astype(np.int64), time[hit])
        changed = np.unique(owner[hit])
        limits[changed] = best.reshape(texts, registers)[changed].max(axis=1)
        going = time < limits[owner]
        seed, rate, low, limit, owner, time = seed[going], rate[going], low[going], limit[going], owner[going], time[going]
    return best.reshape(texts, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """texts x bands matrix of hashes of the bands' registers and place."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), bits.shape[:2]).copy()
    for j in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, j])
    return out.view(np.int64)


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, content, bands array<bigint>, marks binary), one row a row; ``content`` names the word sequence and ``marks``
    has a byte of each register. Rows with a null id or without a word have nulls."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 2 << 20):
            split = [t.encode().split() if t else [] for t in part.column("text").to_pylist()]
            has = np.array([bool(w) for w in split]) & part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            raw = [b" ".join(split[i]) for i in np.flatnonzero(has)]
            keys, weights = shingles(raw)
            registers = signatures(keys, weights, len(raw), bands * rows)
            found = iter(band_keys(registers, bands, rows).tolist())
            bytes_of = iter(mixed(registers.view(np.uint64)).astype(np.uint8))
            names = iter([hashlib.blake2b(r, digest_size=16).hexdigest() for r in raw])
            content = pa.array([next(names) if h else None for h in has], pa.string())
            keys_of = pa.array([next(found) if h else None for h in has], pa.list_(pa.int64()))
            marks = pa.array([next(bytes_of).tobytes() if h else None for h in has], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), content, keys_of, marks], ["doc_id", "content", "bands", "marks"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, content string, bands array<bigint>, marks binary")


def likely(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose registers do not rule out the similarity asked for. ``marks``: (node, marks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("marks_a", "marks_b"))
                limit = percent / 100
                least = limit - DEVIATIONS * (limit * (1 - limit) / a.shape[1]) ** 0.5
                yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= least))

    a = marks.select(F.col("node").alias("a"), F.col("marks").alias("marks_a"))
    b = marks.select(F.col("node").alias("b"), F.col("marks").alias("marks_b"))
    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "marks_a", "marks_b"), run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) of ``pairs`` whose multisets overlap enough. ``texts``: (node, text), one row a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_a", 1 << 20):
            n = part.num_rows
            sides = []
            for name in ("text_a", "text_b"):
                keys, counts = shingles([t.encode() for t in part.column(name).to_pylist()])
                totals = np.bincount((keys >> np.uint64(HASH_BITS)).astype(np.int64), counts, n).astype(np.int64)
                sides.append((keys, counts, totals))
            (ka, ca, ta), (kb, cb, tb) = sides
            both, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
            common = np.bincount((both >> np.uint64(HASH_BITS)).astype(np.int64), np.minimum(ca[ia], cb[ib]), n).astype(np.int64)
            yield part.select(["a", "b"]).filter(pa.array(100 * common >= percent * (ta + tb - common)))

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b"), run, "a long, b long")


def star_step(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (u, v) with u > v: the same components, closer to stars around minima.

    Minima are combined before the shuffle, no neighbourhood is gathered, and the step is stored.
    """
    # Large star: every neighbour above a node moves to the node's smallest neighbour (or the node itself).
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")).select("of", F.least("of", "m").alias("m"))
    large = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Small star: a node's smaller neighbours, and the node, move to the smallest of them.
    lowest = large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    met = large.join(lowest, F.col("u") == F.col("of"))
    small = met.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return stored(small.select("e.*").where(F.col("u") != F.col("v")).distinct(), "stars")


def finished(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node has one smaller neighbour, which has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return counts.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def undecided(buckets: DataFrame) -> DataFrame:
    """(key, band, node, label, n, first) of the buckets whose nodes have two labels or more."""
    about = buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    return buckets.join(about.where(F.col("lo") != F.col("hi")).drop("lo", "hi"), "key")


def shared_counts(texts: DataFrame) -> DataFrame:
    """(node, total, shared array<int>): a text's shingles, and those of each group that another row of ``texts`` has too.

    A shingle of one text is found by its count, combined map-side, whose only node is then its owner: nothing is joined
    back, and a shingle of all texts is one row a task. ``texts``: (node, text), one row a node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 2 << 20):
            keys, counts = shingles([t.encode() for t in part.column("text").to_pylist()])
            ends = np.searchsorted(keys >> np.uint64(HASH_BITS), np.arange(part.num_rows + 1, dtype=np.uint64)).astype(np.int32)
            owner, item = (keys >> np.uint64(HASH_BITS)).astype(np.int64), (keys & MASK).astype(np.int64)
            sums = np.bincount(owner * GROUPS + item % GROUPS, counts, part.num_rows * GROUPS).astype(np.int32).reshape(-1, GROUPS)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (item, counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([part.column("node"), *lists, pa.array(list(sums), pa.list_(pa.int32()))], ["node", "items", "counts", "sums"])

    bags = stored(map_batches(texts.select("node", "text"), run, "node long, items array<bigint>, counts array<int>, sums array<int>"), "bags")
    rows = bags.select("node", F.explode(F.arrays_zip("items", "counts")).alias("x")).select("node", F.col("x.items").alias("item"), F.col("x.counts").alias("w"))
    alone = rows.groupBy("item").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("w").alias("w")).where("n = 1")
    lost = [F.sum(F.when(F.col("item") % GROUPS == g, F.col("w")).otherwise(0)).alias(f"lost_{g}") for g in range(GROUPS)]
    shared = F.array(*[(F.col("sums")[g] - F.coalesce(f"lost_{g}", F.lit(0))).cast("int") for g in range(GROUPS)])
    total = sum((F.col("sums")[g].cast("long") for g in range(GROUPS)), F.lit(0).cast("long"))
    return bags.select("node", "sums").join(alone.groupBy("node").agg(*lost), "node", "left").select("node", total.alias("total"), shared.alias("shared"))


def may_reach(common: Column, total_a: Column, total_b: Column, percent: int) -> Column:
    """Whether an overlap of ``common`` shingles would make two texts similar."""
    return 100 * common >= percent * (total_a + total_b - common)


def candidates(live: DataFrame, round_no: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) to compare now, and the rows of ``live`` that are left for later rounds.

    If ``live`` has ``total`` and ``shared``, pairs that these rule out are not made; they need no comparison.

    Buckets of up to FULL_BUCKET nodes: all pairs of different labels. Larger ones: pivots, namely the smallest node and
    the nodes whose hash falls into a share of (GROWTH^(round - 1) - 1) / n, meet all nodes of other labels; then they are done
    with, as every pair that they are part of is decided. A bucket whose nodes never join is thus compared in full in the
    end. Round 0 leaves all but the first bands as they are.
    """
    small = F.col("n") <= FULL_BUCKET
    draw = (F.xxhash64(F.lit(round_no), "node") % (1 << 20) + (1 << 20)) / float(1 << 21)
    pivot = small | (F.col("node") == F.col("first")) | (draw < (float(GROWTH) ** max(0, round_no - 1) - 1) / F.col("n"))
    turn = F.col("band") < FIRST_BANDS if round_no == 0 else F.lit(True)
    marked = live.withColumn("pivot", pivot & turn)
    more = [c for c in ("total", "shared") if c in live.columns]
    left = marked.where("pivot").select("key", F.col("node").alias("a"), F.col("label").alias("label_a"), *[F.col(c).alias(f"{c}_a") for c in more])
    right = marked.where(turn).select("key", F.col("node").alias("b"), F.col("label").alias("label_b"), F.col("pivot").alias("pivot_b"), *[F.col(c).alias(f"{c}_b") for c in more])
    fits = (F.col("label_a") != F.col("label_b")) & (~F.col("pivot_b") | (F.col("a") < F.col("b")))
    if more:
        most = sum((F.least(F.col("shared_a")[g], F.col("shared_b")[g]).cast("long") for g in range(GROUPS)), F.lit(0).cast("long"))
        fits = fits & may_reach(most, F.col("total_a"), F.col("total_b"), percent)
    met = left.join(right, "key").where(fits)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs, marked.where(~F.col("pivot")).select("key", "band", "node", "label", *more)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, class_id), one row per row of ``docs``: classes are what similar pairs connect, named by their smallest id.

    Similar: the multisets of five-word shingles overlap by ``percent`` hundredths of their union or more. Texts with the same
    words are one node from the start, so copies cost one comparison at most; a text of one to four words has one
    shingle; a text without words, null or empty, is alone. Null ids have a null class. Ids name documents: rows that
    repeat an id are one document (with differing texts, the smallest one is compared). Other columns are not read.
    """
    spark = docs.sparkSession
    sketches = stored(sketch(docs, bands, rows), "sketches")
    reps = stored(sketches.where(F.col("content").isNotNull()).groupBy("content").agg(F.min("doc_id").alias("node")), "contents")
    # One row a content has its smallest id; a repeated row has the same bands, so distinct keys leave one.
    own = sketches.join(reps.withColumnRenamed("content", "rep_content"), (F.col("content") == F.col("rep_content")) & (F.col("doc_id") == F.col("node")))
    keys = own.select("node", F.posexplode("bands").alias("band", "key")).distinct()
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = stored(keys.join(shared, "key").withColumn("label", F.col("node")), "buckets")
    nodes = stored(buckets.select("node").distinct(), "nodes")
    marks = stored(own.join(nodes, "node").groupBy("node").agg(F.min("marks").alias("marks")), "marks")
    found = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node").where(F.col("text").isNotNull())
    texts = stored(found.groupBy("node").agg(F.min("text").alias("text")), "texts")
    tested = spark.createDataFrame([], "a long, b long")
    edges = spark.createDataFrame([], "u long, v long")
    round_no = 0
    while not (live := stored(undecided(buckets), "undecided")).isEmpty():
        if round_no == BOUND_ROUND:
            # What is live now was in large buckets only, with texts of other labels: all that it can still be similar to.
            counts = stored(shared_counts(texts.join(live.select("node").distinct(), "node")), "bounds")
            own_most = sum((F.col("shared")[g].cast("long") for g in range(GROUPS)), F.lit(0).cast("long"))
            bounds = counts.where(may_reach(own_most, F.col("total"), own_most, percent))
            live = stored(live.join(bounds, "node"), "undecided")  # the rows of later rounds keep their bounds
        pairs, rest = candidates(live, round_no, percent)
        pairs = stored(likely(pairs.join(tested, ["a", "b"], "left_anti"), marks, percent), "pairs")
        links = stored(verified(pairs, texts, percent).select(F.col("b").alias("u"), F.col("a").alias("v")), "similar")
        tested = tested.unionByName(pairs)
        # Labels are minima after one step: finer than components, at worst, which only costs comparisons.
        edges = star_step(edges.unionByName(links))
        labels = edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("new"))
        buckets = rest.join(labels, F.col("node") == F.col("of"), "left").drop("of", "label").withColumn("label", F.coalesce("new", "node")).drop("new")
        round_no += 1
    while not finished(edges):
        edges = star_step(edges)
    member = sketches.select("doc_id", "content").join(reps, "content", "left").join(edges, F.col("node") == F.col("u"), "left")
    return member.select("doc_id", F.coalesce("v", "node", "doc_id").alias("class_id"))
