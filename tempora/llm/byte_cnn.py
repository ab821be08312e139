"""Language identification with a convolutional network over bytes, trained here in numpy.

Network: byte embedding, filters of several widths, ReLU, maximum over a fixed-length window, softmax. Every text is cut
into consecutive windows and the prediction is the mean of their probabilities, so whole texts count at any length.
For prediction, embedding and filters are folded into one table per filter offset, so a convolution is a sum of lookups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tempora.llm.common import map_batches, ship, slices, stored

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Bound of the training sample: documents of one language, and windows of one document.
SAMPLE_DOCS = 1500
SAMPLE_WINDOWS = 2
#: Training steps of 64 windows at least; a small sample is gone through more often.
LEAST_STEPS = 800
NO_LANGUAGE = "und"
#: Share of the right predictions on held-out texts that ``least_score`` leaves below it.
REJECTED_RIGHT = 0.01
#: Parts of a range that are counted side by side to find a quantile, and values that are ordered instead.
QUANTILE_PARTS = 4096


def held_out(doc_id: str) -> Column:
    """True for the fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def windows_of(raw: list[bytes], length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive windows of all texts, padded with zero bytes, and how many each text has (one for an empty text)."""
    counts = np.array([max(1, -(-len(r) // length)) for r in raw], np.int64)
    flat = np.zeros(int(counts.sum()) * length, np.uint8)
    for start, r in zip((np.cumsum(counts) - counts) * length, raw):
        flat[start : start + len(r)] = np.frombuffer(r, np.uint8)
    return flat.reshape(-1, length), counts


class ByteNet:
    """The network; weights are set by ``train``."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.weights = {"e": draw(256, EMBEDDING, scale=0.5)}
        for w in WIDTHS:
            self.weights[f"f{w}"] = draw(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5)
            self.weights[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.weights["o"] = draw(len(WIDTHS) * FILTERS, len(classes), scale=0.2)
        self.weights["c"] = np.zeros(len(classes), np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of a batch of windows and its gradients."""
        p, n = self.weights, len(x)
        embedded, tops, kept = p["e"][x], [], {}
        for w in WIDTHS:
            span = x.shape[1] - w + 1
            columns = np.concatenate([embedded[:, j : j + span] for j in range(w)], axis=2)
            z = columns @ p[f"f{w}"] + p[f"b{w}"]
            at = z.argmax(axis=1)
            kept[w] = (columns, at)
            tops.append(np.take_along_axis(z, at[:, None], axis=1)[:, 0])
        h = np.maximum(np.concatenate(tops, axis=1), 0)
        logits = h @ p["o"] + p["c"]
        logits -= logits.max(axis=1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=1, keepdims=True)
        loss = float(-np.log(prob[np.arange(n), y] + 1e-12).mean())
        d = prob
        d[np.arange(n), y] -= 1
        d /= n
        g = {"o": h.T @ d, "c": d.sum(axis=0), "e": np.zeros_like(p["e"])}
        dh = (d @ p["o"].T) * (h > 0)
        rows = np.arange(n)[:, None]
        for k, w in enumerate(WIDTHS):
            columns, at = kept[w]
            dz = dh[:, k * FILTERS : (k + 1) * FILTERS]
            chosen = columns[rows, at]  # window x filter x (w * embedding)
            g[f"f{w}"] = np.einsum("nfd,nf->df", chosen, dz)
            g[f"b{w}"] = dz.sum(axis=0)
            back = (dz[:, :, None] * p[f"f{w}"].T[None]).reshape(n, FILTERS, w, EMBEDDING)
            for j in range(w):
                np.add.at(g["e"], x[rows, at + j], back[:, :, j])
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 4e-3, seed: int = 11) -> float:
        """Adam over shuffled batches, with a fixed seed; returns the mean loss of the last epoch."""
        rng, step, losses = np.random.default_rng(seed), 0, [0.0]
        m, v = ({k: np.zeros_like(w) for k, w in self.weights.items()} for _ in range(2))
        for _ in range(epochs):
            losses, order = [], rng.permutation(len(x))
            for i in range(0, len(x), batch):
                step += 1
                loss, g = self.gradients(x[order[i : i + batch]], y[order[i : i + batch]])
                losses.append(loss)
                for k, d in g.items():
                    m[k] += 0.1 * (d - m[k])
                    v[k] += 0.001 * (d * d - v[k])
                    self.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return float(np.mean(losses))

    def fold(self) -> None:
        """Tables of embedding times filter, one for each offset of each width."""
        p = self.weights
        self.tables = {w: [np.ascontiguousarray(p["e"] @ p[f"f{w}"][j * EMBEDDING : (j + 1) * EMBEDDING]) for j in range(w)] for w in WIDTHS}

    def probabilities(self, x: np.ndarray, block: int = 64) -> np.ndarray:
        out = np.empty((len(x), len(self.classes)), np.float64)
        for i in range(0, len(x), block):
            part, tops = x[i : i + block].astype(np.intp), []
            for w, tables in self.tables.items():
                span = part.shape[1] - w + 1
                z = tables[0].take(part[:, :span], axis=0)
                for j in range(1, w):
                    z += tables[j].take(part[:, j : j + span], axis=0)
                tops.append(z.max(axis=1) + self.weights[f"b{w}"])
            logits = (np.maximum(np.concatenate(tops, axis=1), 0) @ self.weights["o"] + self.weights["c"]).astype(np.float64)
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            out[i : i + block] = e / e.sum(axis=1, keepdims=True)
        return out


def labelled(docs: DataFrame) -> DataFrame:
    """(__id, __text, __lang, __held, __hash of id and text) of the documents with a text and a language."""
    return docs.select(
        F.col("doc_id").alias("__id"), F.col("text").alias("__text"), F.col("lang").alias("__lang"), held_out("doc_id").alias("__held"), F.xxhash64("doc_id", "text").alias("__hash")
    ).where(F.col("__lang").isNotNull() & F.col("__text").isNotNull())


def sample_share(usable: DataFrame, sample_docs: int) -> Column | None:
    """Condition that holds for about a fifth more than ``sample_docs`` different documents of each language; None if there are none."""
    counts = {r["__lang"]: r["n"] for r in usable.groupBy("__lang").agg(F.approx_count_distinct("__hash").alias("n")).collect()}  # one row a class
    if not counts:
        return None
    share = F.coalesce(*[F.when(F.col("__lang") == k, F.lit(min(1.0, 1.2 * sample_docs / n))) for k, n in sorted(counts.items())])
    return (F.shiftright("__hash", 33) + F.lit(1 << 30)) / F.lit(float(1 << 31)) < share  # the smallest hashes


def fit_language(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS, epochs: int = 4) -> ByteNet | None:
    """Train on a sample of the labelled documents that are not held out; None if there are none.

    ``sample_docs`` documents of each language at most, those with the smallest hashes of id and text, and ``sample_windows``
    windows of each, evenly spaced over the text: a bounded sample, cut to windows before it reaches the driver. Texts without
    a letter and null languages are not learned from. Rows that repeat id and text count once.
    """
    usable = labelled(docs).where(~F.col("__held"))
    share = sample_share(usable, sample_docs)
    if share is None:
        return None
    size = F.octet_length("__text")
    picked = usable.where(share & F.col("__text").rlike(r"\p{L}"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(sample_windows - 1)),
        lambda k: F.substring(F.col("__raw"), (k * F.greatest(F.lit(0), size - WINDOW) / max(1, sample_windows - 1)).cast("int") + 1, F.lit(WINDOW)),
    )
    cut = picked.withColumn("__raw", F.col("__text").cast("binary")).select("__id", "__lang", "__hash", pieces.alias("__pieces"))
    # Combined map-side: what repeats an id and a text is one row; the others are about the bound already.
    once = cut.groupBy("__lang", "__hash").agg(F.min(F.struct("__id", "__pieces")).alias("__row"))
    rank = F.row_number().over(Window.partitionBy("__lang").orderBy("__hash"))
    bounded = once.withColumn("__rank", rank).where(F.col("__rank") <= sample_docs)
    rows = bounded.select(F.col("__row.__id").alias("__id"), "__lang", F.explode("__row.__pieces").alias("__piece")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["__lang"], r["__id"] is None, r["__id"], bytes(r["__piece"])))
    classes = sorted({r["__lang"] for r in rows})
    net = ByteNet(classes)
    x, _ = windows_of([bytes(r["__piece"])[:WINDOW] for r in rows])
    net.train(x, np.array([classes.index(r["__lang"]) for r in rows]), max(epochs, -(-LEAST_STEPS * 64 // len(x))))
    return net


def value_at(values: DataFrame, column: str, rank: int, n: int) -> float:
    """The value at a 0-based position in the order of ``column``, of ``n`` rows without nulls.

    Counts of equal parts of the range name the part that holds the position, which is cut again until it is small.
    """
    value = F.col(column)
    while n > QUANTILE_PARTS:
        lo, hi = values.agg(F.min(value), F.max(value)).first()
        if lo == hi:
            return lo
        part = F.floor((value - lo) / (hi - lo) * QUANTILE_PARTS)
        for k, n in sorted(map(tuple, values.groupBy(part.alias("part")).count().collect())):  # QUANTILE_PARTS + 1 rows at most
            if rank < n:
                break
            rank -= n
        values = values.where(part == k)
    return sorted(r[0] for r in values.select(value).collect())[rank]  # QUANTILE_PARTS rows at most


def exact_quantile(values: DataFrame, column: str, share: float) -> float | None:
    """What ``percentile`` gives, without its buffer of all values; None if there are none. ``values`` is read several times."""
    known = values.where(F.col(column).isNotNull())
    n = known.count()
    if not n:
        return None
    at = share * (n - 1)
    below, above = math.floor(at), math.ceil(at)
    low, high = (value_at(known, column, rank, n) for rank in (below, above))
    return low if low == high else (above - at) * low + (at - below) * high


def least_score(docs: DataFrame, net: ByteNet | None, rejected: float = REJECTED_RIGHT) -> float:
    """The score that all but a share ``rejected`` of the right predictions on held-out documents reach; 0 without any.

    Read from every held-out document, whole texts; repeated rows count as often as they occur.
    """
    if net is None:
        return 0.0
    held = labelled(docs).where(F.col("__held")).select("__lang", F.col("__text").alias("text"))
    right = with_language(held, net).where(F.col("__lang") == F.col("__lang_pred"))
    low = exact_quantile(stored(right.select("__lang_score"), "scores"), "__lang_score", rejected)
    return max(0.0, low - 1e-9) if low is not None else 0.0


def predict_language(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): every whole text, no shuffle.

    ``und`` with score 0 if the text is null, empty or has no letter, or if nothing could be learned; ties go to the
    smaller language. Repeated rows get a row each; a null id is kept and not held out; other columns are not read.
    """
    found = with_language(docs.select("doc_id", "text"), net)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__lang_score").alias("score"))


def with_language(docs: DataFrame, net: ByteNet | None, text_col: str = "text") -> DataFrame:
    """All rows and columns with ``__lang_pred`` and ``__lang_score`` added, as ``predict_language`` defines them."""
    ship(docs.sparkSession)
    names = docs.columns
    told = docs.withColumn("__letters", F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    sent = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        if model is not None:
            model.fold()
        for part in slices(batches, text_col, 1 << 20):
            texts = part.column(text_col).to_pylist()
            best, score = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
            told = np.flatnonzero(part.column("__letters").to_numpy(zero_copy_only=False))
            if told.size and model is not None:
                x, counts = windows_of([texts[i].encode() for i in told])
                starts = np.cumsum(counts) - counts
                mean = np.add.reduceat(model.probabilities(x), starts, axis=0) / counts[:, None]
                for i, k, s in zip(told, mean.argmax(axis=1), mean.max(axis=1)):
                    best[i], score[i] = model.classes[k], min(1.0, float(s))
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(names))), pa.array(best, pa.string()), pa.array(score)], [*names, "__lang_pred", "__lang_score"])

    added = T.StructType.fromDDL("__lang_pred string, __lang_score double")
    return map_batches(told, run, T.StructType([*docs.schema.fields, *added.fields]))


def identify_language(docs: DataFrame, train_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``train_on`` (``docs`` by default) and predict every row of ``docs``."""
    return predict_language(docs, fit_language(docs if train_on is None else train_on))
