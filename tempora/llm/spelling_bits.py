"""Spelling variants by a bit-sliced position index.

Words one edit apart share all that lies on one side of the edit, so they meet in a bucket: one half of the word is the
same, at its place from the start or from the end. Buckets above a size are halved again, until they are small or only one
place is left open, where the alphabet bounds them. Nothing is compared beyond a bucket.

A task indexes many buckets at once. For each (position, letter) a bitset over the words says which of them have the letter there,
and one more slice says which words share a bucket. Queries run through all words in parallel, letter by letter, with four bitsets
of words: no error so far; one letter replaced; one more letter in the word, read one position ahead; one letter fewer, read
one position behind. What is set in the end is exactly the words one edit away.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tempora.llm.common import ship, slices, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: A form occurs so many times as often as its variants.
RATIO = 10
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: One occurrence in so many, by a hash of document and word, is read with a letter missing.
NOISE = 31
#: Larger buckets are halved again.
FULL_BUCKET = 4096
#: Words that share an index: 64 to a machine word of each bitset.
INDEX_WORDS = 2048
STATE = ["m", "front", "back", "key"]
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000


def word_counts(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """(word, n): occurrences of the words of all texts, in lower case (A-Z only).

    Where crc32 of '<doc_id>:<word>' is a multiple of ``noise``, the letter at that crc modulo the length is left out; a
    null id is written as nothing. Null and empty texts have no words; a word of one letter may become empty.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(RUN.findall(text.translate(UPPER))).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % noise == 0:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1 :]
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        yield out()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after the other, and each word's length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.fromiter(map(len, words), np.int64, len(words))


def bitsets(letters: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A bitset over the words for each of ``known``: which words have the letter at this position."""
    bits = np.packbits(letters[None, :] == known[:, None], axis=1, bitorder="little")
    out = np.zeros((known.size, -(-letters.size // 64) * 8), np.uint8)
    out[:, : bits.shape[1]] = bits
    return out.view(np.uint64)


def one_error_pairs(words: list[str], bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ordered (query, word) of the same ``bucket`` (numbers in order) whose words are one edit apart."""
    flat, length = letters_of(words)
    n, most = len(words), int(length.max(initial=0))
    start = np.cumsum(length) - length
    at = lambda i: np.where(i < length, flat[np.minimum(start + i, max(flat.size - 1, 0))], 0) if flat.size else np.zeros(n, np.uint32)
    # The slice of the bucket is the first letter that must agree.
    zero = bitsets(bucket, np.arange(int(bucket.max()) + 1))[bucket]
    none = np.zeros_like(zero)
    replaced, longer, shorter = none.copy(), none.copy(), none.copy()
    of_length = {m: bitsets((length == m).astype(np.int64), np.array([1]))[0] for m in np.unique(length).tolist()}
    has = lambda m: of_length.get(m, none[0])
    found = none.copy()

    def slice_at(i: int) -> tuple[np.ndarray, np.ndarray]:
        column = at(i)
        known = np.unique(column)
        return known, bitsets(column, known)

    def matching(own: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        known, sets = index
        place = np.minimum(np.searchsorted(known, own), known.size - 1)
        return np.where((known[place] == own)[:, None], sets[place], np.uint64(0))

    before, here = None, slice_at(0)
    for i in range(most + 1):
        ends = np.flatnonzero(length == i)
        if ends.size:  # queries that are read to their end
            extra = longer[ends] | zero[ends]  # the word's last letter is the one more
            found[ends] = (replaced[ends] & has(i)) | (extra & has(i + 1)) | (shorter[ends] & has(i - 1))
        if i == most:
            break
        after, own = slice_at(i + 1), at(i)
        same = matching(own, here)
        present = ~bitsets(at(i), np.array([0], np.uint32))[0]  # words that go on to this position
        replaced = (replaced & same) | (zero & ~same & present)
        longer = (longer | zero) & matching(own, after)
        shorter = (shorter & matching(own, before) if before is not None else none) | zero
        zero &= same
        before, here = here, after
    bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, :n]
    return np.nonzero(bits)


def halves(words: DataFrame) -> DataFrame:
    """(m, front, back, key, word, n): every word's buckets. ``m`` is the shorter length of the pairs that meet there, ``front``
    and ``back`` how many letters at the start and at the end are known to agree."""
    length = F.char_length("word")
    every = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where(F.col("m") > 0)
    return keyed(every.withColumns({"front": F.lit(0), "back": F.lit(0)}))


def keyed(rows: DataFrame) -> DataFrame:
    """The two halves of what is open between ``front`` and ``back``, each with its key. The half that agrees may be empty only
    if one letter is open."""
    half = F.floor((F.col("m") - F.col("front") - F.col("back")) / 2).cast("int")
    first = F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back"))
    last = F.struct(F.col("front").alias("front"), (F.col("m") - F.col("front") - half).alias("back"))
    split = rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("s")).select("word", "n", "m", "s.front", "s.back")
    start, end = F.substring("word", F.lit(1), F.col("front")), F.expr("if(back = 0, '', right(word, back))")
    return split.withColumn("key", F.xxhash64("m", "front", "back", start, end))


def belongs(a: str, b: str, m: int, front: int, back: int) -> bool:
    """Whether the pair is counted in the buckets of this state: halves are tried front first, so that each pair has one place."""
    if min(len(a), len(b)) != m:
        return False
    f = k = 0
    while (f, k) != (front, back):
        if f > front or k > back:
            return False
        half = (m - f - k) // 2
        if a[: f + half] == b[: f + half]:
            f += half
        else:
            k = m - f - half
        if half == 0:
            return (f, k) == (front, back)
    return True


def near_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, near_n, near): what each word finds in its buckets. Rows come ordered by state and key."""

    def searched(rows: pa.Table) -> pa.RecordBatch:
        key = rows.column("key").to_numpy()
        words, counts = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        m, front, back = (rows.column(c).to_numpy() for c in ("m", "front", "back"))
        new = (key[1:] != key[:-1]) | (m[1:] != m[:-1]) | (front[1:] != front[:-1]) | (back[1:] != back[:-1])
        bucket = np.concatenate([[0], np.cumsum(new)])
        open_part = [w[f : len(w) - k] for w, f, k in zip(words, front.tolist(), back.tolist(), strict=True)]
        near: dict[int, list] = {}
        for q, x in zip(*(x.tolist() for x in one_error_pairs(open_part, bucket)), strict=True):
            if belongs(words[q], words[x], int(m[q]), int(front[q]), int(back[q])):
                best = near.setdefault(q, [0, 0, ""])
                best[0] += 1
                if (-counts[x], words[x]) < (-best[1], best[2]):
                    best[1:] = int(counts[x]), words[x]
        found = [(words[q], *v) for q, v in near.items()]
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["word", "n_near", "near_n", "near"])

    def indexes(rows: pa.Table) -> Iterator[pa.Table]:
        """Whole buckets of two words or more: together up to INDEX_WORDS words, or one larger bucket."""
        if not rows.num_rows:
            return
        state = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in STATE])
        new = np.any(state[:, 1:] != state[:, :-1], axis=0)
        edges = np.concatenate([[0], np.flatnonzero(new) + 1, [rows.num_rows]])
        sizes = np.diff(edges)
        rows = rows.filter(pa.array(np.repeat(sizes > 1, sizes)))
        start = end = 0
        for n in sizes[sizes > 1].tolist():
            if end > start and end + n - start > INDEX_WORDS:
                yield rows.slice(start, end - start)
                start = end
            end += n
        if end > start:
            yield rows.slice(start, end - start)

    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rows = table if kept is None else pa.concat_tables([kept, table])
        if not rows.num_rows:
            continue
        ends = np.ones(rows.num_rows, bool)
        for c in STATE:
            ends &= rows.column(c).to_numpy() == rows.column(c)[-1].as_py()
        cut = rows.num_rows - int(ends.sum())  # the last bucket may go on
        for part in indexes(rows.slice(0, cut)):
            yield searched(part.combine_chunks())
        kept = rows.slice(cut).combine_chunks()
    if kept is not None:
        for part in indexes(kept):
            yield searched(part.combine_chunks())


def near_words(words: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """(word, n_near, near_n, near): for each word that has any, the number of words one edit away, and the most frequent one
    (ties: the smallest in code-point order). ``words``: (word, n), one row a word."""
    buckets, parts = halves(words), None
    while True:
        buckets = stored(buckets, "spelling-buckets")
        sizes = buckets.groupBy(*STATE).agg(F.count("*").alias("size"))
        large = stored(sizes.where((F.col("size") > full_bucket) & (F.col("m") - F.col("front") - F.col("back") > 1)).drop("size"), "large-buckets")
        final = large.isEmpty()
        here = buckets if final else buckets.join(large, STATE, "left_anti")
        dealt = here.repartition(*STATE).sortWithinPartitions(*STATE)
        found = dealt.select(*STATE, "word", "n").mapInArrow(near_in_buckets, "word string, n_near long, near_n long, near string")
        parts = found if parts is None else parts.unionByName(found)
        if final:
            break
        buckets = keyed(buckets.join(large, STATE, "left_semi"))
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("best.less")).alias("near_n"), "best.near")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last one. ``forms``: (word, form), one row a word that has a form.

    Every form is at least RATIO times as frequent as its word, so chains are short and end; each round doubles the way.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = stored(roots.join(further, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return roots


def spelling_groups(docs: DataFrame, noise: int = NOISE, ratio: int = RATIO, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of at least LEAST_LETTERS letters and LEAST_COUNT occurrences.

    ``form``: the most frequent of the words one edit away (ties: the smallest), if it occurs at least ``ratio`` times as often;
    ``root``: the last of the forms that follow, or the word. Repeated rows count again. Only doc_id and text are read.
    An empty table has no words.
    """
    counted = word_counts(docs, noise)
    words = stored(counted.where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LETTERS)), "vocabulary")
    near = words.join(near_words(words, full_bucket), "word", "left")
    formed = F.col("near_n") >= ratio * F.col("n")
    told = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")), "forms")
    roots = rooted(told.where(F.col("form").isNotNull()))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
