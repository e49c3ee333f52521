"""Clusters of users and how well they separate."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.util import inheritable_thread_target

from sensorloom.models.learn import SEED, assemble
from sensorloom.operators.folds import zscore


def kmeans(df: DataFrame, columns: Sequence[str], k: int, restarts: int = 10, out: str = "cluster") -> DataFrame:
    """Best of several seeded starts. `df` is read many times; make it durable."""
    vectors = assemble(df, columns)

    def fit(i: int):
        return KMeans(k=k, seed=SEED + i, predictionCol=out).fit(vectors)

    # the starts are independent
    with ThreadPool(min(restarts, 5)) as pool:
        fitted = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(restarts))
    return min(fitted, key=lambda m: m.summary.trainingCost).transform(vectors)


def silhouette(df: DataFrame, cluster: str = "cluster") -> float:
    """Mean silhouette by squared Euclidean distance, whose sums per cluster need no pairs."""
    return float(ClusteringEvaluator(predictionCol=cluster, featuresCol="features").evaluate(df))


def sweep(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(2, 8), restarts: int = 10) -> DataFrame:
    """Silhouette for each k, on z-scored columns."""
    rows = []
    for k in ks:
        rows.append((int(k), silhouette(kmeans(df, columns, k, restarts))))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def cluster_users(profiles: DataFrame, columns: Sequence[str], k: int, out: str, restarts: int = 10) -> DataFrame:
    """z-score, then k-means; the profile with the cluster column."""
    from sensorloom.session import durable

    scaled = durable(zscore(profiles, columns))
    return kmeans(scaled, [f"{c}_z" for c in columns], k, restarts, out).select(*profiles.columns, out)
