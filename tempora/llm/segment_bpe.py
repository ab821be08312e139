"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary file (``tokenizers`` JSON, BPE with an end-of-word mark) is a parameter and is sent to the tasks once.
Text becomes words as the file prescribes: special tokens are cut out of the raw text, the rest is brought to NFC,
white space runs become one blank, letters are lower-cased one by one, and words are apostrophe endings, letter runs,
single digits and runs of other signs. A word's bytes are its first symbols.

Merging: the leaves of a binary tree are the symbol pairs of a word, each holding (rank, position), and inner nodes
hold the smaller child, so the root is the leftmost pair of lowest rank. A merge changes three leaves and their paths to
the root. All new words of a slice of texts are merged in step, one tree per row of a numpy matrix.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tempora.llm.common import map_batches, ship, slices

NONE = np.int64(1) << 62
POSITION_BITS = 31
#: Chunks that a task remembers, at about 500 bytes each with their words; beyond, it starts afresh, which costs time and changes no result.
CACHE_CHUNKS = 1 << 17


def byte_signs() -> list[str]:
    """The printable sign of each byte in byte-level vocabularies: visible Latin-1 signs stand for themselves, the
    others take the code points from 256 on, in byte order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class Vocabulary:
    """Tables of one vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"] is not None:
            raise ValueError("the vocabulary must be BPE with an end-of-word suffix and no decoder")
        end, ids = model["end_of_word_suffix"], model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([*ids.values(), *self.special.values()])
        self.tokens = [""] * (top + 1)
        for token, i in chain(ids.items(), self.special.items()):
            self.tokens[i] = token
        signs = byte_signs()
        self.inner = np.array([ids[s] for s in signs], np.int64)
        self.last = np.array([ids[s + end] for s in signs], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], -1)


WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


#: Signs that ``str.split`` takes for white space although Unicode's White_Space does not.
NOT_SPACE = re.compile("[\x1c-\x1f]")
SEPARATORS = regex.compile(r"\p{White_Space}+")


def words_of(text: str) -> list[str]:
    """Words of text without special tokens. A sigma is lowered without regard to its place in the word."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return WORDS.findall(text.lower())


def climb(tree: np.ndarray, base: np.ndarray, leaf: np.ndarray) -> None:
    """Renew the ancestors of one leaf of each tree."""
    node = leaf >> 1
    while node[0]:
        child = base + (node << 1)
        tree[base + node] = np.minimum(tree[child], tree[child + 1])
        node = node >> 1


def merge_rows(symbols: np.ndarray, sizes: np.ndarray, leaves: int, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge each row of ``symbols`` (rows x (leaves + 1), ``sizes`` of them used) until its tree's root is empty.

    Returns the matrix and the mask of the symbols that are left.
    """
    rows, width = symbols.shape
    places = np.arange(width)
    alive = places < sizes[:, None]
    tree = np.full((rows, 2 * leaves), NONE, np.int64)
    found = v.rank(symbols[:, :-1], symbols[:, 1:])
    has = (found >= 0) & alive[:, 1:]
    tree[:, leaves:] = np.where(has, (found << POSITION_BITS) | places[:-1], NONE)
    level = leaves
    while level > 1:
        level >>= 1
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    after = np.broadcast_to(places + 1, symbols.shape).copy()
    before = np.broadcast_to(places - 1, symbols.shape).copy()
    flat, tree_flat, alive_flat, after, before = symbols.ravel(), tree.ravel(), alive.ravel(), after.ravel(), before.ravel()
    active = np.flatnonzero(tree[:, 1] < NONE)
    while active.size:
        row, base, size = active * width, active * (2 * leaves), sizes[active]
        root = tree_flat[base + 1]
        at = root & ((1 << POSITION_BITS) - 1)
        gone = after[row + at]
        following = after[row + gone]
        new = v.merged[root >> POSITION_BITS]
        flat[row + at] = new
        alive_flat[row + gone] = False
        after[row + at] = following
        inside = following < size
        before[(row + following)[inside]] = at[inside]
        # The merged pair's own leaf and the one of the symbol that went.
        tree_flat[base + leaves + np.minimum(gone, leaves - 1)] = NONE
        rank = np.where(inside, v.rank(new, flat[row + np.minimum(following, width - 1)]), -1)
        tree_flat[base + leaves + at] = np.where(rank >= 0, (rank << POSITION_BITS) | at, NONE)
        left = before[row + at]
        has = left >= 0
        left = np.maximum(left, 0)
        rank = v.rank(flat[row + left], new)
        kept = tree_flat[base + leaves + left]
        tree_flat[base + leaves + left] = np.where(has, np.where(rank >= 0, (rank << POSITION_BITS) | left, NONE), kept)
        for leaf in (np.minimum(gone, leaves - 1), at, left):
            climb(tree_flat, base, leaf + leaves)
        active = active[tree_flat[base + 1] < NONE]
    return symbols, alive


def merge_words(words: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A pool of token ids, and each word's place and number of tokens in it."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(raw), np.uint8)
    first = v.inner[data]
    first[ends - 1] = v.last[data[ends - 1]]
    begins, places, counts = ends - sizes, np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    leaves_of = np.where(sizes > 1, 1 << np.ceil(np.log2(np.maximum(sizes - 1, 1))).astype(np.int64), 0)
    single = np.flatnonzero(leaves_of == 0)
    places[single] = np.arange(single.size)
    pools, held = [first[begins[single]]], single.size
    for leaves in np.unique(leaves_of[leaves_of > 0]):
        members = np.flatnonzero(leaves_of == leaves)
        step = max(1, (1 << 18) // int(leaves))  # rows at once, so that a matrix stays near 4 MB
        for k in range(0, members.size, step):
            some = members[k : k + step]
            at = begins[some][:, None] + np.arange(leaves + 1)
            symbols, alive = merge_rows(first[np.minimum(at, first.size - 1)], sizes[some], int(leaves), v)
            counts[some] = alive.sum(axis=1)
            places[some] = held + np.cumsum(counts[some]) - counts[some]
            pools.append(symbols[alive])
            held += pools[-1].size
    return np.concatenate(pools), places, counts


class Pool:
    """Token ids of known strings: each has a place and a number of tokens in one growing array."""

    def __init__(self):
        self.index: dict = {}
        self.ids, self.starts, self.sizes = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, keys: list, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.index.update(zip(keys, range(len(self.index), len(self.index) + len(keys))))
        self.starts = np.concatenate([self.starts, starts + self.ids.size])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries end to end, and where each entry ends."""
        sizes = self.sizes[keys]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if stops.size else 0
        return self.ids[np.arange(total) + np.repeat(self.starts[keys] - (stops - sizes), sizes)], stops


class Encoder:
    """Encoder of one task, with the words and white-space-free chunks of text it has met so far.

    No word crosses white space, nor does the normal form, so a chunk's tokens depend on the chunk alone.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.forget()

    def forget(self) -> None:
        self.words, self.chunks, self.shown = Pool(), Pool(), []
        special = [*self.v.special.values()]
        self.keep([(s, True) for s in self.v.special], np.array(special, np.int64), np.arange(1, len(special) + 1))

    def keep(self, chunks: list, ids: np.ndarray, stops: np.ndarray) -> None:
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64) if stops.size else stops
        self.chunks.add(chunks, ids, starts, stops - starts)
        tokens = [self.v.tokens[i] for i in ids.tolist()]
        self.shown += [" ".join(tokens[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]

    def learn(self, chunks: list[str]) -> None:
        split = [words_of(c) for c in chunks]
        known = self.words.index
        new = list({w: None for words in split for w in words if w not in known})
        if new:
            self.words.add(new, *merge_words(new, self.v))
        flat = np.fromiter((known[w] for words in split for w in words), np.int64)
        ids, stops = self.words.gather(flat)
        self.keep(chunks, ids, np.concatenate([[0], stops])[np.cumsum([len(words) for words in split])])

    def cut(self, text: str) -> list:
        if self.v.cut is not None and "<" in text:
            parts = self.v.cut.split(text)
            if len(parts) > 1:
                return [c for i, part in enumerate(parts) for c in ([(part, True)] if i % 2 else self.cut(part))]
        return SEPARATORS.split(text) if NOT_SPACE.search(text) else text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts end to end, how many each has, and each text's decoded form."""
        if len(self.chunks.index) > CACHE_CHUNKS:
            self.forget()
        split = [self.cut(text) for text in texts]
        known = self.chunks.index
        new = list({c for chunks in split for c in chunks}.difference(known))
        if new:
            self.learn(new)
        picked = [[known[c] for c in chunks] for chunks in split]
        shown = self.shown
        decoded = [" ".join([s for k in p if (s := shown[k])]) for p in picked]
        ids, stops = self.chunks.gather(np.fromiter(chain.from_iterable(picked), np.int64, sum(map(len, picked))))
        edges = np.concatenate([[0], stops])[np.cumsum([0, *map(len, picked)])]
        return ids, np.diff(edges), decoded


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text and decode it again: (``id_col``, token_ids array<int>, decoded string), one row per row.

    A null or empty text has no tokens and decodes to an empty string; repeated rows are encoded each. Tokens are
    joined by a blank on decoding, as the vocabulary names no decoder. A text of any length is encoded whole. Other
    columns are not read. No shuffle takes place.
    """
    with open(path, encoding="utf-8") as f:
        content = f.read()
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(content)  # the file: about 2 MB, whatever the table's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(sent.value))
        for part in slices(batches, "__text", 1 << 20):
            texts = [t or "" for t in part.column("__text").to_pylist()]
            ids, sizes, decoded = encoder.encode(texts)
            edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            tokens = pa.ListArray.from_arrays(edges, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("__id"), tokens, pa.array(decoded, pa.string())], ["__id", "token_ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.selectExpr(f"`{id_col}` AS __id", f"`{text_col}` AS __text")
    return map_batches(picked, run, f"__id {kind}, token_ids array<int>, decoded string").withColumnRenamed("__id", id_col)
