"""Ridge regression from sufficient statistics: one scan, then as many fits as wanted.

Tasks add up the products of features, label and a constant, fold by fold; Spark merges them by fold and place. What comes
to the driver is one square table of (features + 2) per fold, whatever the rows are. The rows of a training set are all folds
but one, so its table is the whole minus the fold's own, and a fit is the solution of a small linear system. Weights are
factors of the products. Values are taken from a first row's before they are multiplied, so that large offsets do not cost digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

Coefficients = tuple[float, list[float]]  # intercept, one number per feature


@dataclass(frozen=True)
class Moments:
    """Products of (1, features, label) by fold, of values less `shift`."""

    columns: tuple[str, ...]
    shift: np.ndarray
    by_fold: dict[int, np.ndarray]

    def training(self, without: int | None) -> np.ndarray:
        whole = sum(self.by_fold.values(), np.zeros((len(self.columns) + 2,) * 2))
        return whole if without is None else whole - self.by_fold[without]

    def fit(self, alpha: float, without: int | None = None) -> Coefficients:
        """Least squares with `alpha` times the sum of squared coefficients; the intercept is free."""
        m = self.training(without)
        n = m[0, 0]
        if n <= 0:
            return 0.0, [0.0] * len(self.columns)
        mean = m[0, 1:] / n
        centred = m[1:, 1:] - np.outer(m[0, 1:], mean)
        xx, xy = centred[:-1, :-1], centred[:-1, -1]
        spread = np.sqrt(np.maximum(np.diag(xx), 0.0))
        spread[spread == 0] = 1.0
        # in units of each column's spread, so that the system is well scaled
        system = xx / np.outer(spread, spread) + np.diag(alpha / spread**2)
        scaled = _solve(system, xy / spread)
        b = scaled / spread
        shift = self.shift
        return float(mean[-1] + shift[-1] - b @ (mean[:-1] + shift[:-1])), [float(v) for v in b]


def _solve(system: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        lower = np.linalg.cholesky(system)
    except np.linalg.LinAlgError:  # alpha 0 and columns that depend on each other
        return np.linalg.lstsq(system, right, rcond=None)[0]
    return np.linalg.solve(lower.T, np.linalg.solve(lower, right))


def moments(df: DataFrame, columns: Sequence[str], label: str = "label", fold: str = "fold",
            weight: str | None = None) -> Moments:
    """One scan. Rows with a null feature, label or fold are left out; a null weight counts as 0."""
    names = [*columns, label]
    # one array: constraints on dozens of columns would keep the optimizer busy
    picked = df.select(
        F.col(fold).cast("long").alias("fold"),
        (F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)).alias("weight"),
        F.array(*[F.col(c).cast("double") for c in names]).alias("x"),
    ).where(F.col("fold").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    size = len(names) + 1
    first = picked.first()
    shift = np.array(first["x"], np.float64) if first else np.zeros(len(names))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            folds, w = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = np.ones((len(batch), size))
            rows[:, 1:] = batch.column(2).flatten().to_numpy().reshape(len(batch), size - 1) - shift
            for f in np.unique(folds):
                own = rows[folds == f]
                found[int(f)] = found.get(int(f), 0) + (own * w[folds == f, None]).T @ own
        for f, m in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f], pa.int64()), pa.array([m.ravel()], pa.list_(pa.float64()))], names=["fold", "m"]
            )

    parts = picked.mapInArrow(add_up, "fold long, m array<double>").select("fold", F.posexplode("m").alias("place", "v"))
    rows = parts.groupBy("fold", "place").agg(F.sum("v").alias("v")).collect()  # size * size numbers per fold
    by_fold: dict[int, np.ndarray] = {}
    for r in rows:
        by_fold.setdefault(r.fold, np.zeros(size * size))[r.place] = r.v
    return Moments(tuple(columns), shift, {f: m.reshape(size, size) for f, m in by_fold.items()})


def fits(m: Moments, alphas: Sequence[float]) -> dict[tuple[int, int], Coefficients]:
    """By (fold, place in `alphas`): the fit on all other folds. No further scan."""
    return {(f, i): m.fit(a, f) for f in m.by_fold for i, a in enumerate(alphas)}


def predict(df: DataFrame, columns: Sequence[str], of: Coefficients, out: str = "prediction") -> DataFrame:
    """Add the prediction of one fit to every row."""
    return df.withColumn(out, _product(columns, F.lit(of[0]), F.array(*[F.lit(v) for v in of[1]])))


def _product(columns: Sequence[str], intercept, coefficients):
    x = F.array(*[F.col(c).cast("double") for c in columns])
    products = F.zip_with(x, coefficients, lambda a, b: a * b)
    return intercept + F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


def predict_by_fold(df: DataFrame, columns: Sequence[str], by: Mapping[tuple[int, int], Coefficients],
                    fold: str = "fold") -> DataFrame:
    """Add `draw` and `prediction`: each row once per draw, by the fit that has not seen its fold."""
    table = df.sparkSession.createDataFrame(
        [(f, i, b0, b) for (f, i), (b0, b) in by.items()], "_fold long, draw int, _b0 double, _b array<double>"
    )
    # as many rows as folds and draws
    joined = df.join(F.broadcast(table), F.col(fold).cast("long") == F.col("_fold"))
    return joined.withColumn("prediction", _product(columns, F.col("_b0"), F.col("_b"))).drop("_fold", "_b0", "_b")


def out_of_fold(df: DataFrame, columns: Sequence[str], keep: Sequence[str], alpha: float = 1.0, label: str = "label",
                fold: str = "fold", weight: str | None = None) -> DataFrame:
    """Predictions of each fold by the ridge fitted on the others, from one scan for all fits and one for the predictions."""
    by = fits(moments(df, columns, label, fold, weight), [alpha])
    return predict_by_fold(df, columns, by, fold).select(*dict.fromkeys([*keep, fold, label]), "prediction")
