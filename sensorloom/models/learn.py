"""Fitting and out-of-fold evaluation on top of pyspark.ml."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressor,
    IsotonicRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from sensorloom.functions import columns as C
from sensorloom.models import trees as T

SEED = 42
FEATURES = "features"
Factory = Callable[[DataFrame], Estimator]


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature vector beside the other columns."""
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES, handleInvalid="error").transform(df)


# --- estimators --------------------------------------------------------------------

def ridge(alpha: float = 1.0, label: str = "label") -> Factory:
    """Ridge with the penalty on the sum of squares, as a function of the training rows."""

    def make(train: DataFrame) -> Estimator:
        sd, n = train.agg(F.stddev_pop(label), F.count(label)).first()
        return LinearRegression(
            featuresCol=FEATURES, labelCol=label, regParam=alpha * (sd or 0.0) / max(n, 1),
            elasticNetParam=0.0, standardization=False, solver="normal",
        )

    return make


def forest(label: str = "label", trees: int = 200, depth: int = 10, leaf: int = 5) -> Estimator:
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED
    )


def forest_class(label: str = "label", trees: int = 200, depth: int = 10, leaf: int = 5, weight: str | None = None) -> Estimator:
    model = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED
    )
    return model.setWeightCol(weight) if weight else model


def boosted(label: str = "label", rounds: int = 200, depth: int = 5, rate: float = 0.1, rows: float = 1.0,
            leaf: int = 1, columns: str = "all", weight: str | None = None) -> Estimator:
    """Boosted regression trees. `columns` is the share of features per node, as text."""
    model = GBTRegressor(
        featuresCol=FEATURES, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=rows, minInstancesPerNode=leaf, featureSubsetStrategy=columns, seed=SEED,
    )
    return model.setWeightCol(weight) if weight else model


def boosted_extra(label: str = "label", rounds: int = 500, weight: str | None = None) -> Estimator:
    """Settings of the external boosted-tree libraries, as far as they have a counterpart."""
    return boosted(label, rounds, 6, 0.05, 0.8, 20, "0.8", weight)


def boosted_production(label: str = "label", rounds: int = 455, weight: str | None = None) -> Estimator:
    """The published production settings, as far as they have a counterpart."""
    return boosted(label, rounds, 9, 0.0193, 0.813, 47, "0.826", weight)


def boosted_class(label: str = "label", rounds: int = 200, depth: int = 5, rate: float = 0.1,
                  weight: str | None = None, rows: float = 1.0, leaf: int = 1, columns: str = "all") -> Estimator:
    model = GBTClassifier(
        featuresCol=FEATURES, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=rows, minInstancesPerNode=leaf, featureSubsetStrategy=columns, seed=SEED,
    )
    return model.setWeightCol(weight) if weight else model


def three_class(label: str = "label", rounds: int = 200, depth: int = 5) -> Estimator:
    return OneVsRest(classifier=boosted_class(label, rounds, depth), featuresCol=FEATURES, labelCol=label)


def class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """n0 / n1 for class 1, else 1."""
    ratio = df.agg(C.ratio(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("r")).scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(F.lit(1.0)))


# --- out of fold ---------------------------------------------------------------------

def _estimator(model: Estimator | Factory, train: DataFrame) -> Estimator:
    return model if isinstance(model, Estimator) else model(train)


def _fit(estimator: Estimator, train: DataFrame, in_tasks: bool = False):
    return T.fit(estimator, train) if in_tasks and T.grows(estimator) else estimator.fit(train)


def _logged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """With log1p of the label, and its name."""
    y = f"_fit_{label}"
    return df.withColumn(y, C.log_floor(label)), y


def fold_models(df: DataFrame, model: Estimator | Factory, k: int, label: str = "label", fold: str = "fold",
                log: bool = False, parallelism: int = 5, in_tasks: bool = False) -> list | T.Folds:
    """For each fold, the model fitted on the others; `log` fits log1p(label).

    `in_tasks`: trees of all folds grow in one job (`trees`), with draws of their own. Other fits are independent and
    run side by side.
    """
    data, y = _logged(df, label) if log else (df, label)

    def own(estimator: Estimator) -> Estimator:
        return estimator.copy().setLabelCol(y) if log else estimator

    if in_tasks and isinstance(model, Estimator) and T.grows(model):
        return T.fit_folds(own(model), data, k, fold)

    def fit(i: int):
        train = data.where(F.col(fold) != i)
        return own(_estimator(model, train)).fit(train)

    with ThreadPool(min(parallelism, k)) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(fit), range(k))


def out_of_fold(df: DataFrame, model: Estimator | Factory, k: int, keep: Sequence[str], label: str = "label",
                fold: str = "fold", log: str | None = None, probability: bool = False,
                parallelism: int = 5, in_tasks: bool = False, fitted: list | T.Folds | None = None) -> DataFrame:
    """Predictions of each fold by a model fitted on the others.

    `df` holds the feature vector, label and fold; make it durable first, since
    it is read twice per fold. `log` fits log1p(label) and turns predictions
    back, floored at 0: "plain", or "corrected" by half the residual variance of
    the training rows. `fitted`: what `fold_models` gave for the same rows, model and log or not.
    """
    data, y = _logged(df, label) if log else (df, label)
    if fitted is None:
        fitted = fold_models(df, model, k, label, fold, log is not None, parallelism, in_tasks)
    out = None
    p = F.col("prediction")
    if isinstance(fitted, T.Folds):
        cols = list(dict.fromkeys([*keep, fold, label, *([y] if log else [])]))
        scored = fitted.by_fold(data, cols, fold)
        if log:
            shift = F.lit(0.0)
            if log == "corrected":
                spread = fitted.residual_variance(data, y, fold)
                shift = F.coalesce(*[F.when(F.col(fold) == i, F.lit(v / 2)) for i, v in spread.items()])
            scored = scored.withColumns({"prediction_log": p, "prediction": C.unlog_floor(p + shift)})
        cols = [*keep, fold, label, "prediction", *(["prediction_log", y] if log else [])]
        extra = [F.col("probability")[1].alias("probability")] if probability else []
        return scored.select(*dict.fromkeys(cols), *extra)
    for i, one in enumerate(fitted):
        scored = one.transform(data.where(F.col(fold) == i))
        if log:
            shift = F.lit(0.0)
            if log == "corrected":
                residual = one.transform(data.where(F.col(fold) != i))
                shift = residual.agg((F.var_pop(F.col(y) - p) / 2).alias("s")).scalar()
            scored = scored.withColumns(
                {"prediction_log": p, "prediction": C.unlog_floor(p + shift)}
            )
        cols = [*keep, fold, label, "prediction", *(["prediction_log", y] if log else [])]
        extra = [vector_to_array("probability")[1].alias("probability")] if probability else []
        part = scored.select(*dict.fromkeys(cols), *extra)
        out = part if out is None else out.unionByName(part)
    return out


def importance(model: Estimator | Factory, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature importances of a fit on all rows, greatest first."""
    fitted = _estimator(model, df).fit(df)
    rows = [(c, float(v)) for c, v in zip(columns, fitted.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


# --- calibration -----------------------------------------------------------------------

def fit_isotonic(df: DataFrame, label: str = "label", prediction: str = "prediction"):
    """Monotone fit of the label on out-of-fold predictions."""
    return IsotonicRegression(featuresCol=prediction, labelCol=label, predictionCol="calibrated").fit(
        df.select(F.col(label).cast("double").alias(label), prediction)
    )


def calibrate(model, df: DataFrame) -> DataFrame:
    """Add `calibrated`: linear between the knots, clipped at both ends."""
    return model.transform(df)


# --- search ------------------------------------------------------------------------------

# Ranges of the published searches that have a counterpart here.
RANGES = {
    "first": {"rounds": (200, 1000), "depth": (3, 9), "rate": (0.01, 0.15), "rows": (0.6, 1.0),
              "columns": (0.5, 1.0), "leaf": (10, 60)},
    "production_peak": {"rounds": (300, 1200), "depth": (4, 10), "rate": (0.005, 0.1), "rows": (0.6, 1.0),
                        "columns": (0.5, 1.0), "leaf": (5, 80)},
    "production_late": {"rounds": (200, 1000), "depth": (3, 10), "rate": (0.005, 0.15), "rows": (0.6, 1.0),
                        "columns": (0.5, 1.0), "leaf": (10, 80)},
}


def draw(ranges: dict[str, tuple[float, float]], n: int, seed: int = SEED) -> list[dict]:
    """n seeded draws: whole numbers even, the rate log-even."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        lo, hi = ranges["rate"]
        out.append(
            {
                "maxIter": rng.randint(*map(int, ranges["rounds"])),
                "maxDepth": rng.randint(*map(int, ranges["depth"])),
                "stepSize": lo * (hi / lo) ** rng.random(),
                "subsamplingRate": rng.uniform(*ranges["rows"]),
                "featureSubsetStrategy": f"{rng.uniform(*ranges['columns']):.3f}",
                "minInstancesPerNode": rng.randint(*map(int, ranges["leaf"])),
            }
        )
    return out


def search(df: DataFrame, estimator: Estimator, params: Sequence[dict], k: int, metric: str = "mae",
           label: str = "label", fold: str = "fold", parallelism: int = 4) -> tuple[DataFrame, dict]:
    """Fold mean of the metric for each draw, best first, and the best draw."""
    maps = [{estimator.getParam(n): v for n, v in p.items()} for p in params]
    if metric == "f1":
        evaluator = MulticlassClassificationEvaluator(
            labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0
        )
    else:
        evaluator = RegressionEvaluator(labelCol=label, metricName=metric)
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=k, foldCol=fold,
        parallelism=parallelism,
    )
    scores = cv.fit(df).avgMetrics
    rows = [(i, float(s), *[str(p[n]) for n in sorted(p)]) for i, (s, p) in enumerate(zip(scores, params))]
    names = sorted(params[0])
    schema = "draw int, score double, " + ", ".join(f"{n} string" for n in names)
    order = F.desc("score") if evaluator.isLargerBetter() else F.asc("score")
    table = df.sparkSession.createDataFrame(rows, schema).orderBy(order, "draw")
    pick = max if evaluator.isLargerBetter() else min
    best = pick(range(len(scores)), key=lambda i: scores[i])
    return table, dict(params[best])


# --- cascade, storage, scoring --------------------------------------------------------------

def with_cascade(df: DataFrame, second: DataFrame, key: str = "meal_id") -> DataFrame:
    """Out-of-fold prediction of the second target and its class, as features."""
    p = second.select(key, F.col("prediction").alias("pred_time_to_peak"))
    return df.join(p, key).withColumn("pred_ttp_category", F.coalesce(C.time_class("pred_time_to_peak"), F.lit(1)))


def fit_pipeline(df: DataFrame, model: Estimator | Factory, columns: Sequence[str], in_tasks: bool = False) -> PipelineModel:
    """Assembler and model in one, so that the feature order is saved with it."""
    stage = VectorAssembler(inputCols=list(columns), outputCol=FEATURES)
    return PipelineModel(stages=[stage, _fit(_estimator(model, df), stage.transform(df), in_tasks)])


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_order(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Of a stored pipeline."""
    last = model.stages[-1]
    if not T.known(last):
        return model.transform(df)
    return T.transform(last, PipelineModel(stages=model.stages[:-1]).transform(df))


def score(df: DataFrame, peak: PipelineModel, calibrator, late: PipelineModel) -> DataFrame:
    """Raw and calibrated peak, probability of a late peak, labels and bands."""
    raw = transform(peak, df).withColumnRenamed("prediction", "peak_raw").drop(FEATURES)
    cal = calibrator.setFeaturesCol("peak_raw").setPredictionCol("peak_value_predicted").transform(raw)
    timed = transform(late, cal).withColumn("ttp_probability", vector_to_array("probability")[1])
    return timed.select(
        *df.columns,
        "peak_raw",
        "peak_value_predicted",
        "ttp_probability",
        C.ttp_label("ttp_probability", closed=True, cut=0.40).alias("ttp_label"),
        C.ttp_minutes("ttp_probability").alias("ttp_minutes"),
        C.response_band("peak_value_predicted").alias("classification"),
        (F.col("peak_value_predicted") - F.col("glucose_preprandial")).alias("amplitude_predicted"),
    )


def results_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small table of results, one row per model or setting."""
    return spark.createDataFrame(list(rows), schema)
