"""Benchmark, production fit and scoring on the feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.models import cluster, learn
from sensorloom.operators import metrics as M
from sensorloom.operators.folds import group_folds, impute_median
from sensorloom.operators.nutrition import interactions_basic
from sensorloom.operators.profiles import name_clusters, nutrition_profile, response_profile
from sensorloom.operators.ranks import scalars, wide_medians
from sensorloom.plans.pipeline import feature_columns, training_table, with_codes
from sensorloom.session import durable

K = 5


def cluster_profiles(dataset: DataFrame, readings: DataFrame, restarts: int = 10) -> DataFrame:
    """Profiles with both clusters and their names, one row per user."""
    food = durable(nutrition_profile(dataset))
    food = cluster.cluster_users(food, fixed.NUTRITION_CLUSTER_INPUTS, 3, "nutri_cluster", restarts)
    food = name_clusters(food, "nutri_cluster", "est_daily_calories", fixed.NUTRITION_CLUSTER_NAMES, "nutri_cluster_name")
    answer = durable(response_profile(dataset, readings))
    answer = cluster.cluster_users(answer, fixed.RESPONSE_CLUSTER_INPUTS, 2, "glyc_cluster", restarts)
    answer = name_clusters(answer, "glyc_cluster", "time_in_range", fixed.RESPONSE_CLUSTER_NAMES, "glyc_cluster_name")
    return food.join(answer, "user_id", "left")


def with_clusters(dataset: DataFrame, profiles: DataFrame) -> DataFrame:
    """Cluster ids as features."""
    ids = profiles.select("user_id", "nutri_cluster", "glyc_cluster")
    return dataset.join(ids, "user_id", "left").withColumns(
        {f"{c}_num": F.coalesce(F.col(c), F.lit(0)) for c in ("nutri_cluster", "glyc_cluster")}
    )


def peak_table(dataset: DataFrame, production: bool = True, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Training table for the peak value."""
    coded = with_codes(dataset).where(F.col("peak_value") > 0)
    columns = feature_columns(coded, production)
    rows = training_table(coded, columns, "peak_value", [*keep, "ts"], K)
    return rows, columns


def time_table(dataset: DataFrame, production: bool = True) -> tuple[DataFrame, list[str]]:
    """Training table for the time to the peak."""
    t = F.col("time_to_peak_min")
    coded = with_codes(dataset).where((t > 0) & (t <= fixed.POST_MIN))
    columns = feature_columns(coded, production)
    rows = training_table(coded, columns, "time_to_peak_min", [], K)
    return rows, columns


def late_table(dataset: DataFrame) -> tuple[DataFrame, list[str]]:
    """Training table for late against fast peaks; moderate ones are left out."""
    coded = with_codes(dataset).where(C.is_extreme_time("time_to_peak_min"))
    coded = coded.withColumn("is_late", C.late_label("time_to_peak_min"))
    columns = feature_columns(coded, True, late=True)
    rows = training_table(coded, columns, "is_late", ["time_to_peak_min"], K)
    return learn.class_weight(rows), columns


def iauc_table(dataset: DataFrame) -> tuple[DataFrame, list[str]]:
    """Training table for the incremental area, with the features of the first models; gaps take the column's median."""
    coded = with_codes(interactions_basic(dataset)).where(F.col("iauc").isNotNull())
    columns = C.existing(
        coded.columns,
        [*fixed.BASE_FEATURES, *fixed.USER_FEATURES, *[f"{c}_enc" for c in fixed.CATEGORICAL_FEATURES], *fixed.INTERACTION_FEATURES],
    )
    rows = durable(coded.select(
        "meal_id", "user_id", *[F.col(c).cast("double").alias(c) for c in columns], F.col("iauc").cast("double").alias("label")
    ))
    return durable(group_folds(impute_median(rows, columns), K)), columns


def result_row(spark, name: str, oof: DataFrame, extra: str = "") -> DataFrame:
    return M.regression_metrics(oof).select(F.lit(name).alias("model"), "mae", "rmse", "r2", F.lit(extra).alias("changes"))


def benchmark(dataset: DataFrame, rounds: int = 200, trees: int = 200) -> DataFrame:
    """Fold means of the first models on the peak value, best first."""
    rows, columns = peak_table(dataset, production=False)
    rows = learn.assemble(rows, columns)
    models = {
        "ridge": learn.ridge(),
        "forest": learn.forest(trees=trees),
        "boosted": learn.boosted(rounds=rounds),
        "boosted_extra": learn.boosted_extra(rounds=rounds),
    }
    out = None
    for name, model in models.items():
        part = result_row(rows.sparkSession, name, learn.out_of_fold(rows, model, K, ["meal_id"]))
        out = part if out is None else out.unionByName(part)
    return M.rank_models(durable(out), "mae")


def production(dataset: DataFrame, earlier: DataFrame | None = None, rounds: int = 455, draws: int = 0,
               late_rounds: int = 200, ranges: dict | None = None) -> dict:
    """Weighted, searched and calibrated peak model, and the late/fast model.

    `earlier`: predictions with user_id and abs_error, for the weights; without it
    the unweighted model of this run gives them.
    """
    return fit_production(*peak_table(dataset), *late_table(dataset), earlier, rounds, draws, late_rounds, ranges)


def fit_production(rows: DataFrame, columns: list[str], late_rows: DataFrame, late_columns: list[str],
                   earlier: DataFrame | None = None, rounds: int = 455, draws: int = 0, late_rounds: int = 200,
                   ranges: dict | None = None) -> dict:
    """`production` on training tables that are at hand."""
    rows, late_rows = learn.assemble(rows, columns), learn.assemble(late_rows, late_columns)
    spark = rows.sparkSession
    keep = ["meal_id", "user_id"]
    plain = durable(learn.out_of_fold(rows, learn.boosted_production(rounds=rounds), K, keep))
    errors = earlier if earlier is not None else M.with_errors(plain)
    weights = M.user_weights(errors).select("user_id", "weight")
    weighted_rows = durable(
        rows.join(weights, "user_id", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    )
    model = learn.boosted_production(rounds=rounds, weight="weight")
    oof = durable(learn.out_of_fold(weighted_rows, model, K, keep))
    results = [result_row(spark, "plain", plain), result_row(spark, "weighted", oof, "weights")]
    found = None
    if draws:
        params = learn.draw(ranges or learn.RANGES["production_peak"], draws)
        found, best = learn.search(weighted_rows, model, params, K)
        model = model.copy({model.getParam(n): v for n, v in best.items()})
        oof = durable(learn.out_of_fold(weighted_rows, model, K, keep))
        results.append(result_row(spark, "searched", oof, "weights, search"))
    calibrator = learn.fit_isotonic(oof)
    calibrated = learn.calibrate(calibrator, oof)
    table = results[0]
    for part in results[1:]:
        table = table.unionByName(part)
    pooled = M.pooled_metrics(calibrated, "label", "calibrated").select(
        F.lit("calibrated").alias("model"), "mae", "rmse", "r2", F.lit("weights, isotonic (seen rows)").alias("changes")
    )
    late_model = learn.boosted_class(rounds=late_rounds, weight="weight")
    late_oof = learn.out_of_fold(late_rows, late_model, K, keep, probability=True)
    return {
        "results": M.rank_models(table.unionByName(pooled), "mae"),
        "search": found,
        "predictions": calibrated,
        "late_predictions": late_oof,
        "calibrator": calibrator,
        "peak": learn.fit_pipeline(weighted_rows.drop("features"), model, columns),
        "late": learn.fit_pipeline(late_rows.drop("features"), late_model, late_columns),
        "columns": columns,
        "late_columns": late_columns,
    }


def scoring_table(dataset: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature rows of known meals; gaps take the column's median, absent columns 0."""
    coded = with_codes(dataset)
    there = C.existing(coded.columns, columns)
    rows = coded.select("meal_id", *[F.col(c).cast("double").alias(c) for c in there])
    filled = scalars(rows, wide_medians(rows, there, "_m_"))
    return filled.select(
        "meal_id",
        *[
            F.coalesce(c, f"_m_{c}", F.lit(0.0)).alias(c) if c in there else F.lit(0.0).alias(c)
            for c in dict.fromkeys([*columns, "glucose_preprandial"])
        ],
    )
