"""Evaluation of prediction tables as aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed


def with_errors(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    e = F.col(prediction) - F.col(label)
    return df.withColumns({"error": e, "abs_error": F.abs(e)})


def _regression(y: Column, p: Column) -> list[Column]:
    """MAE, RMSE, R2 as aggregates; R2 from the residual and the total spread."""
    residual = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return [
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (1 - F.try_divide(residual, spread)).alias("r2"),
    ]


def regression_by_fold(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       fold: str = "fold") -> DataFrame:
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return rows.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"), *_regression(F.col(label), F.col(prediction))
    )


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       fold: str = "fold") -> DataFrame:
    """Fold means of MAE, RMSE and R2, as one row."""
    return regression_by_fold(df, label, prediction, fold).agg(
        F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2")
    )


def pooled_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return rows.agg(*_regression(F.col(label), F.col(prediction)))


def metrics_by_model(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """One row per model (name -> column of its predictions) with its pooled metrics, in one pass over `df`."""
    y = F.col(label)
    found = []
    for name, column in predictions.items():
        both = y.isNotNull() & F.col(column).isNotNull()
        found.append(F.struct(F.lit(name).alias("model"), *_regression(F.when(both, y), F.when(both, F.col(column)))))
    return df.agg(F.array(*found).alias("_all")).select(F.explode("_all").alias("_m")).select("_m.*")


def mape(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Pooled over all rows with a label other than 0."""
    y, p = F.col(label), F.col(prediction)
    return df.agg((F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100).alias("mape"))


def confusion(df: DataFrame, label: str, prediction: str, classes: Sequence[int]) -> DataFrame:
    """Counts by true class (rows) and predicted class (columns)."""
    counts = df.groupBy(label).pivot(prediction, list(classes)).count().na.fill(0)
    return counts.select(
        F.col(label).alias("label"), *[F.col(str(c)).alias(f"pred_{c}") for c in classes]
    )


def _ratio0(x: Column, y: Column) -> Column:
    return F.coalesce(F.try_divide(x, y), F.lit(0.0))


def binary_by(df: DataFrame, keys: Sequence[str], label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 for each key."""
    y, p = F.col(label), F.col(prediction)
    tp, fp, fn = (
        F.count_if((y == 1) & (p == 1)), F.count_if((y == 0) & (p == 1)), F.count_if((y == 1) & (p == 0)),
    )
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        _ratio0(tp, tp + fp).alias("precision"),
        _ratio0(tp, tp + fn).alias("recall"),
        _ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def macro_by(df: DataFrame, keys: Sequence[str], label: str, prediction: str, classes: Sequence[int]) -> DataFrame:
    """Accuracy and macro F1 for each key; a class in neither column is left out."""
    y, p = F.col(label), F.col(prediction)
    f1, seen = F.lit(0.0), F.lit(0)
    for c in classes:
        hit = F.count_if((y == c) & (p == c))
        either = F.count_if(y == c) + F.count_if(p == c)
        f1 = f1 + _ratio0(2 * hit, either)
        seen = seen + (either > 0).cast("int")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        (f1 / seen).alias("f1_macro"),
    )


def bias_by_range(df: DataFrame, label: str, predictions: dict[str, str], least: int = 5) -> DataFrame:
    """Mean error and absolute error of each prediction by range of the label."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, p in predictions.items():
        e = F.col(p) - F.col(label)
        aggs += [F.avg(e).alias(f"bias_{name}"), F.avg(F.abs(e)).alias(f"mae_{name}")]
    ranged = df.withColumn("range", C.value_range(label)).where(F.col("range").isNotNull())
    return ranged.groupBy("range").agg(*aggs).where(F.col("n") >= least)


def error_distribution(df: DataFrame, error: str = "abs_error",
                       thresholds: Sequence[float] = fixed.ERROR_THRESHOLDS) -> DataFrame:
    """Percent of rows with an error below each threshold, in one pass."""
    shares = df.agg(
        F.array(
            *[
                F.struct(F.lit(float(t)).alias("t"), (F.avg((F.col(error) < t).cast("double")) * 100).alias("pct"))
                for t in thresholds
            ]
        ).alias("_a")
    )
    return shares.select(F.explode("_a").alias("_s")).select(
        F.col("_s.t").alias("threshold"), F.col("_s.pct").alias("pct")
    )


def cutoff_sweep(df: DataFrame, label: str, probability: str,
                 cutoffs: Sequence[float] = fixed.CUTOFFS) -> DataFrame:
    """F1 and accuracy of class 1 at each cut-off, in one pass."""
    y = F.col(label) == 1
    rows = []
    for t in cutoffs:
        p = F.col(probability) >= t
        tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
        rows.append(
            F.struct(
                F.lit(float(t)).alias("cutoff"),
                _ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                F.avg((y == p).cast("double")).alias("accuracy"),
            )
        )
    return df.agg(F.array(*rows).alias("_a")).select(F.explode("_a").alias("_s")).select("_s.*")


def user_errors(df: DataFrame, error: str = "abs_error", user: str = "user_id") -> DataFrame:
    """Mean absolute error of each user beside that of all rows."""
    overall = df.agg(F.avg(error).alias("m")).scalar()
    return df.groupBy(user).agg(F.avg(error).alias("user_mae")).withColumn("global_mae", overall)


def user_weights(df: DataFrame, error: str = "abs_error", user: str = "user_id") -> DataFrame:
    return user_errors(df, error, user).withColumn("weight", C.sample_weight("user_mae", "global_mae"))


def rank_models(results: DataFrame, metric: str, ascending: bool = True, by: Sequence[str] = (),
                tie: str = "model") -> DataFrame:
    """Order result rows (one per model) and flag the best."""
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    # result tables hold one row per model
    w = Window.partitionBy(*by).orderBy(order, tie) if by else Window.orderBy(order, tie)
    return results.withColumn("place", F.row_number().over(w)).withColumn("is_best", F.col("place") == 1)


def compare_to(results: DataFrame, baseline: str, metrics: Sequence[str], name: str = "model") -> DataFrame:
    """Differences of each metric to the baseline row, and in percent of it."""
    base = results.where(F.col(name) == baseline).agg(F.struct(*[F.max(m).alias(m) for m in metrics])).scalar()
    cols = {}
    for m in metrics:
        cols[f"delta_{m}"] = F.col(m) - base[m]
        cols[f"delta_{m}_pct"] = F.try_divide(F.col(m) - base[m], F.abs(base[m])) * 100
    return results.withColumns(cols)


def align(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows both prediction tables have, side by side."""
    return a.join(b, key)
