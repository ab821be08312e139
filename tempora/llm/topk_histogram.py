"""Exact top-k search by distributed histogram selection.

Vectors are floored to integers and every query is scored against every vector, in blocks, several times over. The
first passes only count: each narrows, for every query, the interval of scores that holds its k-th best. The last pass
emits the rows that reach the k-th best score, and ties are broken by id. A pass recomputes scores, which costs a
matrix product, instead of storing them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tempora.llm.common import ship, stored

SCALE = 256
#: Rows of a block of vectors or of queries: a block of scores takes 2048 x 512 x 8 bytes = 8 MB.
VECTOR_BLOCK, QUERY_BLOCK = 2048, 512
#: A pass cuts the interval of a query's k-th best score into 2^BITS bins.
BITS = 12
#: The score of a row against itself; no real score is as low.
NOTHING = -(1 << 62)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(__id, __v array<bigint>): floor(scale * x), x as double. Null ids and vectors, and vectors holding null, NaN or
    infinity, are left out."""
    inf = float("inf")
    usable = F.forall("__x", lambda x: x.isNotNull() & ~F.isnan(x) & (x < inf) & (x > -inf))
    cast = vectors.select(F.col(id_col).cast("long").alias("__id"), F.col(vector_col).cast("array<double>").alias("__x"))
    return cast.where(F.col("__id").isNotNull() & F.col("__x").isNotNull() & usable).select("__id", F.transform("__x", lambda x: F.floor(x * scale)).alias("__v"))


def packed(rows: DataFrame, block: int, parts: int) -> DataFrame:
    """Blocks of at most ``block`` rows (__id, __v, __low) of one length, packed inside each task: ids, data and lows as
    binary, and a ``__part`` that deals the blocks out evenly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                ids, low, lists = some.column("__id").to_numpy(), some.column("__low").to_numpy(), some.column("__v")
                sizes = lists.value_lengths().to_numpy()
                values, edges = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
                for dim in np.unique(sizes):
                    picked = np.flatnonzero(sizes == dim)
                    data = values[(edges[picked][:, None] + np.arange(dim)).ravel()]
                    k += 1
                    yield pa.RecordBatch.from_pydict(
                        {
                            "__part": pa.array([(int(ids[picked[0]]) + k) % parts], pa.int32()),
                            "dim": pa.array([int(dim)], pa.int32()),
                            **{name: pa.array([x.astype(np.int64).tobytes()], pa.binary()) for name, x in (("ids", ids[picked]), ("data", data), ("low", low[picked]))},
                        }
                    )

    return rows.select("__id", "__v", "__low").mapInArrow(run, "__part int, dim int, ids binary, data binary, low binary")


def scores_of(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products: as floats through the matrix product while every sum stays below 2^53."""
    q_top, v_top = int(np.abs(q).max(initial=0)), int(np.abs(v).max(initial=0))
    if q_top * v_top * max(1, q.shape[1]) < 1 << 53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


def scored(pairs: DataFrame, answer: Callable, schema: str) -> DataFrame:
    """Score each pair of a query block and a vector block; ``answer(q_ids, v_ids, scores, low)`` gives the result's columns.

    A query's own row scores NOTHING.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, v_ids, low, q, v = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids", "q_low", "q_data", "data"))
                scores = scores_of(q.reshape(len(q_ids), -1), v.reshape(len(v_ids), -1))
                scores[q_ids[:, None] == v_ids[None, :]] = NOTHING
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in answer(q_ids, v_ids, scores, low)], names)

    return pairs.mapInArrow(run, schema)


def local_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th largest value (the smallest, if it has fewer)."""
    return np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else scores.min(axis=1)


def top_k(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", query_every: int = 50, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row whose id is divisible by ``query_every``, exactly.

    Score: inner product of the floored vectors, which must fit 64-bit integers; larger is better, ties go to the
    smaller id, ranks start at 1. A query's own id is no candidate; with fewer candidates all are returned. Rows that repeat
    an id are candidates each, and a query id that repeats is one query (its smallest vector). Vectors are compared with
    those of equal length. Vectors that are null or hold null or non-finite components take no part; an empty table has
    an empty result.

    Vectors are shuffled once, in packed blocks dealt out to parts; every pass sends each part the query blocks, which
    is the stated query set against all rows. A block's answer to a counting pass is, per query, the bins from its own
    k-th best upwards (no lower one can hold the k-th best of all), so k rows at most; they are summed per query and bin.
    In the last pass it is its own k best by score and id, however many rows tie.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(quantised(vectors, id_col, vector_col, scale), "vectors")
    squared = F.aggregate("__v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    shape = rows.agg(F.count("*").alias("n"), F.max(squared).alias("top")).first()
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-shape["n"] // (VECTOR_BLOCK * 16)))
    blocks = stored(packed(rows.withColumn("__low", F.lit(0).cast("long")), VECTOR_BLOCK, parts).repartition("__part"), "vector-blocks").drop("low")
    queries = stored(rows.where(F.col("__id") % query_every == 0).groupBy("__id").agg(F.min("__v").alias("__v")), "queries")

    def pairs(state: DataFrame | None) -> DataFrame:
        low = F.lit(0).cast("long").alias("__low") if state is None else F.col("low").alias("__low")
        asked = queries if state is None else queries.join(state, queries["__id"] == state["query_id"])
        q = packed(asked.select("__id", "__v", low), QUERY_BLOCK, 1).select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("low").alias("q_low"))
        sent = q.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return blocks.join(sent, (F.col("__part") == F.col("q_part")) & (F.col("dim") == F.col("q_dim")))

    # No score is farther from 0 than the largest squared length, so this many bits hold all of them.
    bits = int(shape["top"] or 0).bit_length() + 1
    state, shift, before = None, max(0, bits - BITS), None
    while True:

        def count(q_ids, v_ids, scores, low, shift=shift, before=before):
            real = scores != NOTHING
            if before is not None:
                real &= (scores >> before) == low[:, None]
            bins = np.where(real, scores >> shift, NOTHING)
            q, v = np.nonzero(real & (bins >= local_best(bins, k)[:, None]))
            order = np.lexsort((bins[q, v], q))
            q, found = q[order], bins[q, v][order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(q) != 0) | (np.diff(found) != 0)])) if q.size else np.zeros(0, np.int64)
            return q_ids[q[first]], found[first], np.diff(np.concatenate([first, [q.size]]))

        bins = scored(pairs(state), count, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        reach = F.sum("n").over(Window.partitionBy("query_id").orderBy(F.desc("bin")))
        if state is not None:
            bins = bins.join(state.select(F.col("query_id").alias("of"), "above"), F.col("query_id") == F.col("of")).withColumn("reach", reach + F.col("above"))
        else:
            bins = bins.withColumn("reach", reach)
        # The highest bin with which k rows are reached; the lowest of all, if there are fewer rows.
        choice = F.struct(F.when(F.col("reach") >= k, F.col("bin")).alias("reached"), (-F.col("bin")).alias("lowest"))
        found = bins.groupBy("query_id").agg(F.max_by(F.struct("bin", (F.col("reach") - F.col("n")).alias("above")), choice).alias("at"))
        state = stored(found.select("query_id", F.col("at")["bin"].alias("low"), F.col("at")["above"].alias("above")), "kth-bin")
        if shift == 0:
            break
        before, shift = shift, max(0, shift - BITS)

    def pick(q_ids, v_ids, scores, low):
        by_id = np.argsort(v_ids, kind="stable")
        scores, ids = scores[:, by_id], v_ids[by_id]
        real = (scores != NOTHING) & (scores >= low[:, None])
        q, v = np.nonzero(real & (scores >= local_best(scores, k)[:, None]))
        order = np.lexsort((v, -scores[q, v], q))
        q, v = q[order], v[order]
        place = np.arange(q.size) - np.searchsorted(q, q)
        q, v = q[place < k], v[place < k]
        return q_ids[q], ids[v], scores[q, v]

    best = scored(pairs(state), pick, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
