"""Randomised search over boosted-tree parameters with expanding-window folds."""

from __future__ import annotations

import json
import random
import time
from dataclasses import dataclass
from math import prod
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tempora.errors import GuardError
from tempora.models.frames import FEATURES, assembler, check_fit_input, fit, fit_rows
from tempora.models.rounds import TASK_CELLS, fold_errors
from tempora.models.trees import DEFAULT_ROUNDS, boosting_estimator
from tempora.operators.metrics import cv_summary
from tempora.operators.split import fold_blocks
from tempora.schemas import SEARCH_SPACE, SEED, TARGET, TS
from tempora.session import materialise


ROUNDS = "n_estimators"


def draw_candidates(space: dict[str, list], n: int, seed: int = SEED) -> list[dict]:
    """``n`` different parameter sets, reproducible by seed (all of them when fewer exist)."""
    sizes = [len(v) for v in space.values()]
    total = prod(sizes)
    picks = random.Random(seed).sample(range(total), min(n, total))
    out = []
    for pick in picks:
        chosen = {}
        for (name, values), size in zip(space.items(), sizes):
            pick, i = divmod(pick, size)
            chosen[name] = values[i]
        out.append(chosen)
    return out


def same_but_rounds(candidates: list[dict]) -> list[list[int]]:
    """Positions of the candidates, together where only the number of rounds differs."""
    families: dict[str, list[int]] = {}
    for i, c in enumerate(candidates):
        families.setdefault(json.dumps({k: v for k, v in c.items() if k != ROUNDS}, sort_keys=True), []).append(i)
    return list(families.values())


@dataclass
class SearchResult:
    model: PipelineModel
    best_parameters: dict
    best_score: float
    results: DataFrame


def tune_boosted(
    train: DataFrame,
    features: list[str],
    target: str = TARGET,
    ts: str = TS,
    series: tuple[str, ...] = (),
    n_iter: int = 25,
    n_splits: int = 4,
    seed: int = SEED,
    parallelism: int = 4,
    space: dict[str, list] | None = None,
    max_bins: int = 256,
) -> SearchResult:
    """Mean validation MAE over expanding folds picks the winner, refitted on all of ``train``.

    A fit whose rows one worker can hold (``TASK_CELLS``) runs inside one task, as many at once as there are cores. A larger one is
    a distributed job of many tasks; ``parallelism`` bounds how many of those are submitted at once. Rows are assembled and stored
    once, by block of time, and every fold reads the blocks it needs. Candidates that differ only in their rounds share one
    fit of the most rounds: its first trees are the smaller models, which one pass scores together; the fit's time is shared out
    by rounds. A smaller search is a smaller ``space`` or ``n_iter``; drawn values are used as they are.
    """
    if n_iter < 1:
        raise GuardError("search: n_iter must be positive")
    if n_splits < 2:
        raise GuardError("search: at least two folds are needed")
    check_fit_input(train, features, target)
    candidates = draw_candidates(space or SEARCH_SPACE, n_iter, seed)
    base = train.select(*series, ts, *features, target)
    vectors = assembler(features).transform(base).select(
        *series, ts, FEATURES, F.col(target).cast("double").alias(target)
    )
    # One copy for all folds; partitions by block, so that a fold reads its own part only.
    blocks = materialise(fold_blocks(materialise(vectors), n_splits, ts, series), "blocks", partition_by=("block",))
    families = same_but_rounds(candidates)

    rows_of = {r["block"]: r["count"] for r in blocks.groupBy("block").count().collect()}  # a row per block

    def cells(f: int) -> int:
        return len(features) * sum(n for block, n in rows_of.items() if block <= f + 1)

    def score(task: tuple[list[int], int]) -> list[tuple[int, int, float, float, float]]:
        members, f = task
        rounds = [int(candidates[c].get(ROUNDS, DEFAULT_ROUNDS)) for c in members]
        longest = {**candidates[members[0]], ROUNDS: max(rounds)}
        estimator = boosting_estimator(longest, seed, max_bins).setFeaturesCol(FEATURES).setLabelCol(target)
        # Mean absolute error after each round.
        if cells(f) <= TASK_CELLS:
            fold = blocks.filter(F.col("block") <= f + 1).select(FEATURES, target, (F.col("block") == f + 1).alias("is_test"))
            tested, trained, took = fold_errors(fold, FEATURES, target, "is_test", estimator)
        else:
            train_part = fit_rows(blocks.filter(F.col("block") <= f).select(FEATURES, target))
            started = time.perf_counter()
            model = estimator.fit(train_part)
            took = time.perf_counter() - started
            test_part = blocks.filter(F.col("block") == f + 1).select(FEATURES, target)
            tested, trained = (model.evaluateEachIteration(part, "absolute") for part in (test_part, train_part))
        return [(c, f, float(tested[n - 1]), float(trained[n - 1]), took * n / max(rounds)) for c, n in zip(members, rounds, strict=True)]

    def work(task: tuple[list[int], int]) -> int:
        members, f = task
        return cells(f) * max(int(candidates[c].get(ROUNDS, DEFAULT_ROUNDS)) for c in members)

    # The longest fits go first, so that no core is left with one at the end.
    tasks = sorted(((members, f) for members in families for f in range(n_splits)), key=work, reverse=True)
    scores = []
    for held, width in ((True, max(parallelism, train.sparkSession.sparkContext.defaultParallelism)), (False, parallelism)):
        if some := [t for t in tasks if (cells(t[1]) <= TASK_CELLS) == held]:
            with ThreadPool(max(1, min(width, len(some)))) as pool:
                scores += [s for found in pool.map(score, some, chunksize=1) for s in found]
    spark = train.sparkSession
    table = spark.createDataFrame(
        scores, "candidate int, fold int, validation_MAE double, training_MAE double, fit_time double"
    )
    params = spark.createDataFrame(
        [(i, json.dumps(c)) for i, c in enumerate(candidates)], "candidate int, params string"
    )
    results = (
        cv_summary(table)
        .join(params, "candidate")
        .select(
            "rank_test_score",
            "mean_validation_MAE",
            "std_validation_MAE",
            "mean_training_MAE",
            "mean_fit_time",
            "params",
        )
        .orderBy("rank_test_score", "params")
    )
    best = results.first()
    chosen = json.loads(best["params"])
    model = fit(boosting_estimator(chosen, seed, max_bins), base, features, target)
    return SearchResult(model, chosen, best["mean_validation_MAE"], results)
