"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks. With weight w, a source's k-th block (from 1) is released at slot floor((k - 1) / w) and
due by slot ceil(k / w); each slot takes, among the released blocks, the one due first. On one line of slots with weights
that sum to 1 every block meets its deadline, so at every slot each source is less than one block away from its share.

Weights are taken as exact fractions, so no error adds up with the input. Blocks are dealt in order on the driver, which holds
one entry per source and writes the plan out in parts; the table meets the plan in an equality join on (source, block).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tempora.llm.common import hashed_ranks, stored, stored_parts

#: Documents of a block, and blocks that are dealt and written out at a time.
BLOCK_DOCS, PERIOD = 16, 1 << 18
PLAN = pa.schema([("p_source", pa.string()), ("p_block", pa.int64()), ("p_slot", pa.int64())])


def whole_shares(weights: dict[str, float], period: int = 1024) -> dict[str, int]:
    """Weights rounded to whole blocks of a period, one at least: largest remainders, ties to the smaller name.

    For a mix that has to repeat. ``schedule`` does not round.
    """
    period = max(period, 4 * len(weights))
    total = sum(Fraction(w) for w in weights.values())
    if not weights or min(weights.values()) <= 0:
        raise ValueError("target weights must be positive")
    exact = {s: Fraction(w) / total * period for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    spare = period - sum(shares.values())
    for k in range(max(0, spare)):
        shares[by_rest[k % len(by_rest)]] += 1
    for _ in range(max(0, -spare)):  # sources lifted to one block are paid for by the largest
        shares[max(shares, key=lambda s: (shares[s], s))] -= 1
    return shares


def deal(weights: dict[str, float | Fraction], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block from 0, slot) of all blocks, by slot: earliest deadline first; ties to the smaller name.

    Releases and deadlines come from the exact weights. A source that has run out takes no more slots, which makes no other
    block late; slots without a released block are passed over.
    """
    exact = {s: Fraction(w) for s, w in weights.items()}
    if not exact or min(exact.values()) <= 0:
        raise ValueError("target weights must be positive")
    scale = lcm(*(w.denominator for w in exact.values()))
    part = {s: int(w * scale) for s, w in exact.items()}
    total, slot = sum(part.values()), 0
    waiting = [(0, s, 0) for s in sorted(part) if blocks.get(s, 0)]
    ready: list[tuple[int, str, int]] = []
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // part[s]), s, k))
        end, s, k = heapq.heappop(ready)
        if end <= slot:
            raise AssertionError("a block missed its deadline")
        yield s, k, slot
        slot += 1
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, ((k + 1) * total // part[s], s, k + 1))


def one_period(shares: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block in period, slot) of one period of whole shares, which starts and ends with no deviation."""
    return list(deal(shares, shares))


def plan_parts(weights: dict[str, float], blocks: dict[str, int], rows: int) -> Iterator[pa.Table]:
    """The dealt blocks in tables of ``rows`` rows."""
    dealt = deal(weights, blocks)
    while part := list(islice(dealt, rows)):
        yield pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), PLAN)], schema=PLAN)


def target_weights(docs: DataFrame, source_col: str = "source", temperature: float = 0.5) -> dict[str, float]:
    """Weights in proportion to the documents of a source to the power ``temperature``. A null source counts as ''.

    One row per source reaches the driver: sources are the entries of a mixing plan, not data.
    """
    counts = docs.groupBy(F.coalesce(F.col(source_col), F.lit("")).alias("s")).agg(F.count("*").alias("n")).collect()
    return {r["s"]: r["n"] ** temperature for r in sorted(counts)}


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", block_docs: int = BLOCK_DOCS, period: int = PERIOD, temperature: float = 0.5) -> DataFrame:
    """(id, source, mix_block, mix_slot, mix_place): when each document has its turn; reads two columns only.

    Read in the order of (mix_slot, mix_place) the documents follow the target mix: after any slot each source that has not run
    out is less than one block away from its target weight. ``weights``: by source, null sources
    under ''; None takes ``target_weights``. Every source of the table needs a weight, else ValueError. Nothing is dropped or
    repeated: a source that runs out leaves its slots empty, and the others keep their shares among themselves. Within a
    source the order is a pseudo-random one, fixed by the id. Rows that repeat an id within a source (null is an id, too)
    share one turn and make one row here. The last block of a source may be short. An empty table gives an empty schedule.
    ``period``: blocks dealt at a time, which bounds the driver's memory and not the result.
    """
    spark = docs.sparkSession
    weights = target_weights(docs, source_col, temperature) if weights is None else weights
    source = F.coalesce(F.col(source_col), F.lit(""))
    keys = stored(docs.select(F.col(id_col).alias("__id"), source.alias("__source")).distinct(), "mix-keys")
    counts = {r["__source"]: r["n"] for r in keys.groupBy("__source").agg(F.count("*").alias("n")).collect()}  # one row a source
    if unknown := sorted(set(counts) - set(weights)):
        raise ValueError(f"source without a target weight: {unknown[0]!r}")
    parts = plan_parts(weights, {s: -(-n // block_docs) for s, n in counts.items()}, period) if weights else iter(())
    plan = stored_parts(spark, parts, "p_source string, p_block long, p_slot long", "mix-plan")
    ranked = hashed_ranks(keys, "__source", ["__id"], sum(counts.values()), "__rank")
    blocks = ranked.withColumn("mix_block", F.floor(F.col("__rank") / block_docs))
    turns = blocks.join(plan, (F.col("__source") == F.col("p_source")) & (F.col("mix_block") == F.col("p_block")))
    return turns.select(
        F.col("__id").alias(id_col),
        F.col("__source").alias(source_col),
        "mix_block",
        F.col("p_slot").alias("mix_slot"),
        (F.col("__rank") % block_docs).alias("mix_place"),
    )


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """All rows and columns of ``docs``, dealt out and sorted so that the written files, in order, follow the schedule."""
    turns = schedule(docs, weights, id_col, source_col, **options)
    turns = stored(turns.select(F.col(id_col).alias("__m_id"), F.col(source_col).alias("__m_source"), F.col("mix_slot").alias("__m_slot"), F.col("mix_place").alias("__m_place")), "mix-turns")
    same = F.col(id_col).eqNullSafe(F.col("__m_id")) & (F.coalesce(F.col(source_col), F.lit("")) == F.col("__m_source"))
    joined = docs.join(turns, same).drop("__m_id", "__m_source")
    picked = [F.col(c) for c in docs.columns]
    return joined.repartitionByRange("__m_slot", "__m_place").sortWithinPartitions("__m_slot", "__m_place").select(*picked)
