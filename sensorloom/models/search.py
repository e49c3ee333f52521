"""Search over drawn settings by successive halving.

Draws are scored on a small budget first; of each rung the best part goes on to the next, larger one. The scores of a rung
are written as a table before the next begins, so a broken run goes on where it stopped. A boosted fit of R rounds is scored
after each of its prefixes by the model itself (`evaluateEachIteration`), so the number of rounds is searched at no cost.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.util import inheritable_thread_target

from sensorloom.models import ridge
from sensorloom.operators import metrics as M
from sensorloom.sources import io

Score = Callable[[list[int], int], DataFrame]  # (draws, budget) to rows (draw, fold, rounds, score)
SCHEMA = "draw int, fold int, rounds int, score double"


def log_draws(lo: float, hi: float, n: int, seed: int = 42) -> list[float]:
    """n seeded numbers, even on a log scale."""
    rng = random.Random(seed)
    return [lo * (hi / lo) ** rng.random() for _ in range(n)]


def ranked(scores: DataFrame, keep: int, larger: bool = False) -> DataFrame:
    """A rung's draws: the mean over folds at the best number of rounds, the place, and whether the draw goes on."""
    means = scores.groupBy("draw", "rounds").agg(F.avg("score").alias("score"), F.count("*").cast("int").alias("n_folds"))
    best = F.max_by if larger else F.min_by
    # of equal scores the fewest rounds
    first = best(F.struct("score", "rounds", "n_folds"), F.struct("score", (F.lit(-1) if larger else F.lit(1)) * F.col("rounds")))
    rows = means.groupBy("draw").agg(first.alias("b")).select("draw", "b.rounds", "b.n_folds", "b.score")
    order = F.col("score").desc_nulls_last() if larger else F.col("score").asc_nulls_last()
    place = F.row_number().over(Window.orderBy(order, "draw"))  # one row per draw
    return rows.withColumn("place", place).withColumn("goes_on", F.col("place") <= keep)


def halving(df: DataFrame, n: int, budgets: Sequence[int], score: Score, path: str, share: int = 3,
            larger: bool = False) -> DataFrame:
    """The trial table of all rungs: rung, draw, rounds, n_folds, score, place, goes_on. In the last rung the best one goes on.

    `path`: a folder for the rungs' scores; a rung that is there already is read. `df` gives the session only.
    """
    spark = df.sparkSession
    alive, out = list(range(n)), None
    for rung, budget in enumerate(budgets):
        at = f"{path}/rung{rung}"
        if not io.exists(spark, f"{at}/_SUCCESS"):
            io.write_table(score(alive, budget), at)
        last = rung == len(budgets) - 1
        rows = ranked(io.read_table(spark, at), 1 if last else max(1, math.ceil(len(alive) / share)), larger)
        rows = rows.withColumn("rung", F.lit(rung))
        out = rows if out is None else out.unionByName(rows)
        alive = sorted(r.draw for r in rows.where("goes_on").select("draw").collect())  # at most n
    return out


def boosted_scores(df: DataFrame, estimator: Estimator, params: Sequence[dict], k: int, label: str = "label",
                   fold: str = "fold", parallelism: int = 4) -> Score:
    """Mean absolute error of each prefix of boosted trees, out of fold. The budget is the number of rounds."""

    def one(job: tuple[int, int, int]) -> list[tuple[int, int, int, float]]:
        draw, i, rounds = job
        settings = {estimator.getParam(n): v for n, v in params[draw].items() if n != "maxIter"}
        model = estimator.copy({**settings, estimator.getParam("maxIter"): min(rounds, params[draw].get("maxIter", rounds))})
        fitted = model.fit(df.where(F.col(fold) != i))
        errors = fitted.evaluateEachIteration(df.where(F.col(fold) == i), "absolute")
        return [(draw, i, r + 1, float(e)) for r, e in enumerate(errors)]

    def score(draws: list[int], rounds: int) -> DataFrame:
        jobs = [(d, i, rounds) for d in draws for i in range(k)]
        with ThreadPool(min(parallelism, len(jobs))) as pool:
            found = pool.map(inheritable_thread_target(df.sparkSession)(one), jobs)
        return df.sparkSession.createDataFrame([r for rows in found for r in rows], SCHEMA)

    return score


def ridge_scores(df: DataFrame, columns: Sequence[str], alphas: Sequence[float], label: str = "label",
                 fold: str = "fold") -> Score:
    """Mean absolute error of each penalty, out of fold. The budget is the number of folds that are scored.

    The sufficient statistics are taken once; a rung is one scan of its folds, with the predictions of all its draws side by side.
    """
    taken = ridge.moments(df, columns, label, fold)

    def score(draws: list[int], folds: int) -> DataFrame:
        some = sorted(taken.by_fold)[:folds]
        by = {(f, d): taken.fit(alphas[d], f) for f in some for d in draws}
        rows = ridge.predict_by_fold(df.where(F.col(fold).isin(some)), columns, by, fold)
        found = M.regression_by_fold(rows.withColumn("_by", F.struct("draw", F.col(fold).alias("fold"))), label, fold="_by")
        return found.select("_by.draw", F.col("_by.fold").cast("int").alias("fold"), F.lit(1).alias("rounds"), F.col("mae").alias("score"))

    return score
