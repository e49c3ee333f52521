"""Evaluation of predictions. The rolling mean of earlier responses is the
predictor, and the rolling time share stands for a probability."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.operators import metrics as M
from sensorloom.operators.context import rolling_user
from sensorloom.plans.q_context import ROLL_PARTS
from sensorloom.plans.q_response import PARTS, both, r6, responses
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import ctes, r
from sensorloom.session import durable
from sensorloom.sources import roles

PRED_PARTS = {
    **PARTS, **ROLL_PARTS,
    "pred": "SELECT meal_id, user_id, peak_value, time_to_peak_min, glucose_preprandial, user_peak_mean_roll AS prediction,"
    " user_ttp_mean_roll AS ttp_prediction, user_ttp_mean_roll / 180 AS p, user_id % 5 AS fold,"
    " CASE WHEN time_to_peak_min < 45 THEN 0 WHEN time_to_peak_min <= 75 THEN 1 ELSE 2 END AS y3,"
    " CASE WHEN user_ttp_mean_roll < 45 THEN 0 WHEN user_ttp_mean_roll <= 75 THEN 1 ELSE 2 END AS p3,"
    " CASE WHEN time_to_peak_min > 75 THEN 1 ELSE 0 END AS y2, CASE WHEN user_ttp_mean_roll > 75 THEN 1 ELSE 0 END AS p2,"
    " abs(user_peak_mean_roll - peak_value) AS abs_error FROM roll WHERE user_peak_mean_roll IS NOT NULL",
}
PRED = ctes("readings", "meals", extra=PRED_PARTS)
F1 = "coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0)"


def count(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def f1_sql(y: str, p: str) -> str:
    return F1.format(tp=count(f"{y} AND {p}"), fp=count(f"NOT ({y}) AND {p}"), fn=count(f"{y} AND NOT ({p})"))


def predictions(spark, sf_dir):
    _, readings = both(spark, sf_dir)
    out = rolling_user(responses(spark, sf_dir), readings, roles.SCALE)
    ttp = F.col("user_ttp_mean_roll")
    return out.where(F.col("user_peak_mean_roll").isNotNull()).select(
        "meal_id", "user_id", "peak_value", "time_to_peak_min", "glucose_preprandial",
        F.col("user_peak_mean_roll").alias("prediction"), ttp.alias("ttp_prediction"), (ttp / 180).alias("p"),
        F.pmod("user_id", F.lit(5)).alias("fold"), C.time_class("time_to_peak_min").alias("y3"),
        C.time_class(ttp).alias("p3"), C.late_label("time_to_peak_min").alias("y2"), C.late_label(ttp).alias("p2"),
        F.abs(F.col("user_peak_mean_roll") - F.col("peak_value")).alias("abs_error"),
    )


FOLD = (
    "SELECT fold, count(*) AS n, avg(abs(peak_value - prediction)) AS mae, sqrt(avg(pow(peak_value - prediction, 2))) AS rmse,"
    " 1 - sum(pow(peak_value - prediction, 2)) / (var_pop(peak_value) * count(*)) AS r2 FROM pred GROUP BY fold"
)


@query("a29_metrics_by_fold", PRED + f"SELECT fold, n, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('r2')} AS r2 FROM ({FOLD})")
def by_fold(spark, sf_dir):
    return r6(M.regression_by_fold(predictions(spark, sf_dir), "peak_value"), "mae", "rmse", "r2")


@query(
    "a29_metrics_fold_mean",
    PRED + f"SELECT {r('avg(mae)')} AS mae, {r('avg(rmse)')} AS rmse, {r('avg(r2)')} AS r2 FROM ({FOLD})",
)
def fold_mean(spark, sf_dir):
    return r6(M.regression_metrics(predictions(spark, sf_dir), "peak_value"), "mae", "rmse", "r2")


@query(
    "a30_mape",
    PRED + "SELECT " + r("avg(abs((peak_value - prediction) / nullif(peak_value, 0))) * 100") + " AS mape FROM pred",
)
def mape(spark, sf_dir):
    return r6(M.mape(predictions(spark, sf_dir), "peak_value"), "mape")


@query(
    "a31_binary_scores",
    PRED + f"SELECT fold, count(*) AS n, {r('avg(CASE WHEN y2 = p2 THEN 1.0 ELSE 0 END)')} AS accuracy, "
    + r("coalesce(" + count("y2 = 1 AND p2 = 1") + " / nullif(" + count("p2 = 1") + ", 0), 0)") + " AS precision, "
    + r("coalesce(" + count("y2 = 1 AND p2 = 1") + " / nullif(" + count("y2 = 1") + ", 0), 0)") + " AS recall, "
    + r(f1_sql("y2 = 1", "p2 = 1")) + " AS f1 FROM pred GROUP BY fold",
)
def binary(spark, sf_dir):
    return r6(M.binary_by(predictions(spark, sf_dir), ["fold"], "y2", "p2"), "accuracy", "precision", "recall", "f1")


SEEN = "(" + " + ".join(f"CASE WHEN {count(f'y3 = {c} OR p3 = {c}')} > 0 THEN 1 ELSE 0 END" for c in (0, 1, 2)) + ")"


@query(
    "a31_macro_f1",
    PRED + f"SELECT fold, count(*) AS n, {r('avg(CASE WHEN y3 = p3 THEN 1.0 ELSE 0 END)')} AS accuracy, "
    + r("(" + " + ".join(f1_sql(f"y3 = {c}", f"p3 = {c}") for c in (0, 1, 2)) + f") / {SEEN}")
    + " AS f1_macro FROM pred GROUP BY fold",
)
def macro(spark, sf_dir):
    return r6(M.macro_by(predictions(spark, sf_dir), ["fold"], "y3", "p3", [0, 1, 2]), "accuracy", "f1_macro")


@query(
    "a32_confusion",
    PRED + f"SELECT CAST(y2 AS INTEGER) AS label, {count('p2 = 0')} AS pred_0, {count('p2 = 1')} AS pred_1 FROM pred GROUP BY y2",
)
def confusion(spark, sf_dir):
    return M.confusion(predictions(spark, sf_dir), "y2", "p2", [0, 1])


BINS = " ".join(f"WHEN peak_value >= {lo} AND peak_value < {hi} THEN '{name}'" for lo, hi, name in fixed.BIAS_RANGES)


@query(
    "a33_bias_by_range",
    PRED + f"SELECT CASE {BINS} END AS \"range\", count(*) AS n, {r('avg(prediction - peak_value)')} AS bias_roll,"
    f" {r('avg(abs_error)')} AS mae_roll, {r('avg(coalesce(glucose_preprandial, prediction) - peak_value)')} AS bias_last,"
    f" {r('avg(abs(coalesce(glucose_preprandial, prediction) - peak_value))')} AS mae_last FROM pred"
    " WHERE peak_value < 999 GROUP BY 1 HAVING count(*) >= 5",
)
def bias(spark, sf_dir):
    df = predictions(spark, sf_dir).withColumn("last", F.coalesce("glucose_preprandial", "prediction"))
    out = M.bias_by_range(df, "peak_value", {"roll": "prediction", "last": "last"})
    return r6(out, "bias_roll", "mae_roll", "bias_last", "mae_last")


@query(
    "a34_error_distribution",
    PRED + " UNION ALL ".join(
        f"SELECT {float(t)}::DOUBLE AS threshold, {r(f'avg(CASE WHEN abs_error < {t} THEN 100.0 ELSE 0 END)')} AS pct FROM pred"
        for t in fixed.ERROR_THRESHOLDS
    ),
)
def distribution(spark, sf_dir):
    return r6(M.error_distribution(predictions(spark, sf_dir)), "pct")


@query(
    "a35_cutoff_sweep",
    PRED + " UNION ALL ".join(
        f"SELECT {t}::DOUBLE AS cutoff, {r(f1_sql('y2 = 1', f'p >= {t}'))} AS f1,"
        f" {r(f'avg(CASE WHEN (y2 = 1) = (p >= {t}) THEN 1.0 ELSE 0 END)')} AS accuracy FROM pred"
        for t in fixed.CUTOFFS
    ),
)
def sweep(spark, sf_dir):
    return r6(M.cutoff_sweep(predictions(spark, sf_dir), "y2", "p"), "f1", "accuracy")


@query(
    "a37_user_errors",
    PRED + f"SELECT user_id, {r('avg(abs_error)')} AS user_mae, {r('(SELECT avg(abs_error) FROM pred)')} AS global_mae"
    " FROM pred GROUP BY user_id",
)
def user_errors(spark, sf_dir):
    return r6(M.user_errors(predictions(spark, sf_dir)), "user_mae", "global_mae")


WEIGHT = "least(greatest(avg(abs_error) / (SELECT avg(abs_error) FROM pred), 0.5), 3.0)"


@query(
    "e22_sample_weight",
    PRED + f", w AS (SELECT user_id, {WEIGHT} AS w FROM pred GROUP BY user_id) SELECT meal_id, {r('coalesce(w, 1)')} AS weight"
    " FROM resp LEFT JOIN w USING (user_id)",
)
def weights(spark, sf_dir):
    w = M.user_weights(predictions(spark, sf_dir)).select("user_id", "weight")
    rows = responses(spark, sf_dir).select("meal_id", "user_id").join(w, "user_id", "left")
    return r6(rows.withColumn("weight", F.coalesce("weight", F.lit(1.0))), "weight").select("meal_id", "weight")


@query(
    "t03_top_users_by_weight",
    PRED + f"SELECT user_id, {r(WEIGHT)} AS weight FROM pred GROUP BY user_id ORDER BY {WEIGHT} DESC, user_id LIMIT 5",
)
def top_weights(spark, sf_dir):
    w = M.user_weights(predictions(spark, sf_dir)).select("user_id", "weight")
    return r6(w.orderBy(F.desc("weight"), "user_id").limit(5), "weight")


@query("e12_time_class", PRED + "SELECT meal_id, CAST(y3 AS INTEGER) AS real_cat, CAST(p3 AS INTEGER) AS pred_cat FROM pred")
def classes(spark, sf_dir):
    return predictions(spark, sf_dir).select("meal_id", F.col("y3").alias("real_cat"), F.col("p3").alias("pred_cat"))


@query(
    "e13_late_label",
    PRED + "SELECT meal_id, CAST(y2 AS INTEGER) AS late FROM pred WHERE time_to_peak_min < 45 OR time_to_peak_min > 75",
)
def late(spark, sf_dir):
    df = predictions(spark, sf_dir).where(C.is_extreme_time("time_to_peak_min"))
    return df.select("meal_id", F.col("y2").alias("late"))


@query(
    "e18_response_band",
    PRED + "SELECT meal_id, CASE WHEN prediction < 140 THEN 'Normal' WHEN prediction < 180 THEN 'Elevado' ELSE 'Muy elevado' END"
    " AS classification, " + r("prediction - glucose_preprandial") + " AS amplitude FROM pred",
)
def bands(spark, sf_dir):
    df = predictions(spark, sf_dir)
    out = df.select(
        "meal_id", C.response_band("prediction").alias("classification"),
        (F.col("prediction") - F.col("glucose_preprandial")).alias("amplitude"),
    )
    return r6(out, "amplitude")


@query(
    "e19_ttp_label",
    PRED + "SELECT meal_id, CASE WHEN p > 0.35 AND p < 0.65 THEN 'uncertain' WHEN p > 0.5 THEN 'late' ELSE 'fast' END AS open_band,"
    " CASE WHEN p >= 0.35 AND p <= 0.65 THEN 'uncertain' WHEN p < 0.4 THEN 'fast' ELSE 'late' END AS closed_band,"
    " CAST(CASE WHEN p > 0.65 THEN 90 WHEN p < 0.35 THEN 35 ELSE 60 END AS INTEGER) AS ttp_minutes FROM pred",
)
def labels(spark, sf_dir):
    return predictions(spark, sf_dir).select(
        "meal_id", C.ttp_label("p").alias("open_band"), C.ttp_label("p", closed=True, cut=0.40).alias("closed_band"),
        C.ttp_minutes("p").alias("ttp_minutes"),
    )


@query(
    "e21_baseline_band",
    PRED + "SELECT meal_id, CASE WHEN glucose_preprandial < 70 THEN 'low' WHEN glucose_preprandial <= 100 THEN 'optimal'"
    " WHEN glucose_preprandial <= 140 THEN 'raised' WHEN glucose_preprandial > 140 THEN 'high' END AS band FROM pred",
)
def baseline(spark, sf_dir):
    return predictions(spark, sf_dir).select("meal_id", C.baseline_band("glucose_preprandial").alias("band"))


MODELS = {
    "rolling": "prediction", "last_value": "coalesce(glucose_preprandial, prediction)",
    "overall_mean": "(SELECT avg(peak_value) FROM pred)",
}
RESULTS = " UNION ALL ".join(
    f"SELECT '{n}' AS model, avg(abs(peak_value - ({e}))) AS mae, sqrt(avg(pow(peak_value - ({e}), 2))) AS rmse,"
    f" 1 - sum(pow(peak_value - ({e}), 2)) / (var_pop(peak_value) * count(*)) AS r2 FROM pred"
    for n, e in MODELS.items()
)


def results(spark, sf_dir):
    df = durable(predictions(spark, sf_dir))
    mean = df.agg(F.avg("peak_value").alias("m")).scalar()
    by = {"rolling": F.col("prediction"), "last_value": F.coalesce("glucose_preprandial", "prediction"), "overall_mean": mean}
    return M.metrics_by_model(df.withColumns({f"_p_{name}": p for name, p in by.items()}), "peak_value", {n: f"_p_{n}" for n in by})


@query("u03_append_results", PRED + f"SELECT model, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('r2')} AS r2 FROM ({RESULTS})")
def append(spark, sf_dir):
    return r6(results(spark, sf_dir), "mae", "rmse", "r2")


@query(
    "w08_best_model",
    PRED + f"SELECT model, {r('mae')} AS mae, CAST(row_number() OVER (ORDER BY mae, model) AS INTEGER) AS place,"
    f" row_number() OVER (ORDER BY mae, model) = 1 AS is_best FROM ({RESULTS})",
)
def best(spark, sf_dir):
    return r6(M.rank_models(results(spark, sf_dir), "mae"), "mae").select("model", "mae", "place", "is_best")


@query(
    "m21_model_comparison",
    PRED + f", t AS ({RESULTS}), b AS (SELECT * FROM t WHERE model = 'overall_mean') SELECT t.model, "
    + ", ".join(
        f"{r(f't.{m} - b.{m}')} AS delta_{m}, {r(f'(t.{m} - b.{m}) / abs(b.{m}) * 100')} AS delta_{m}_pct" for m in ("mae", "rmse")
    )
    + " FROM t, b",
)
def comparison(spark, sf_dir):
    cols = ("delta_mae", "delta_mae_pct", "delta_rmse", "delta_rmse_pct")
    return r6(M.compare_to(results(spark, sf_dir), "overall_mean", ["mae", "rmse"]), *cols).select("model", *cols)


VALID_A = "peak_value IS NOT NULL AND peak_value > 0"
VALID_B = "time_to_peak_min > 0 AND time_to_peak_min <= 180"


@query(
    "j17_align_predictions",
    PRED + f"SELECT a.meal_id, {r('a.prediction')} AS peak_pred, {r('b.ttp_prediction')} AS ttp_pred"
    f" FROM (SELECT * FROM pred WHERE {VALID_A}) a JOIN (SELECT * FROM pred WHERE {VALID_B}) b USING (meal_id)",
)
def aligned(spark, sf_dir):
    df = predictions(spark, sf_dir)
    t = F.col("time_to_peak_min")
    a = df.where(F.col("peak_value") > 0).select("meal_id", F.col("prediction").alias("peak_pred"))
    b = df.where((t > 0) & (t <= 180)).select("meal_id", F.col("ttp_prediction").alias("ttp_pred"))
    return r6(M.align(a, b, "meal_id"), "peak_pred", "ttp_pred")


@query(
    "u02_common_ids",
    PRED + f"SELECT meal_id FROM pred WHERE {VALID_A} INTERSECT SELECT meal_id FROM resp WHERE iauc > 1000",
)
def common(spark, sf_dir):
    a = predictions(spark, sf_dir).where(F.col("peak_value") > 0).select("meal_id")
    return a.intersect(responses(spark, sf_dir).where(F.col("iauc") > 1000).select("meal_id"))


@query(
    "m15_bias_correction",
    PRED + ", v AS (SELECT var_pop(ln(1 + peak_value) - ln(1 + prediction)) / 2 AS s FROM pred) SELECT meal_id, "
    + r("greatest(exp(ln(1 + prediction) + s) - 1, 0)") + " AS corrected FROM pred, v",
)
def corrected(spark, sf_dir):
    df = predictions(spark, sf_dir)
    gap = F.log1p("peak_value") - F.log1p("prediction")
    shift = df.agg((F.var_pop(gap) / 2).alias("s")).scalar()
    return r6(df.select("meal_id", C.unlog_floor(F.log1p("prediction") + shift).alias("corrected")), "corrected")


@query(
    "m23_prediction_table",
    PRED + f"SELECT meal_id, user_id, {r('peak_value')} AS peak_value, {r('prediction')} AS peak_pred_raw,"
    f" {r('prediction - peak_value')} AS error_raw, {r('abs_error')} AS abs_error_raw, CAST(y2 AS INTEGER) AS real_binary,"
    " CAST(p2 AS INTEGER) AS pred_binary, CAST(CASE WHEN y2 = p2 THEN 1 ELSE 0 END AS INTEGER) AS correct FROM pred",
)
def prediction_table(spark, sf_dir):
    df = M.with_errors(predictions(spark, sf_dir), "peak_value", "prediction")
    out = df.select(
        "meal_id", "user_id", "peak_value", F.col("prediction").alias("peak_pred_raw"), F.col("error").alias("error_raw"),
        F.col("abs_error").alias("abs_error_raw"), F.col("y2").alias("real_binary"), F.col("p2").alias("pred_binary"),
        (F.col("y2") == F.col("p2")).cast("int").alias("correct"),
    )
    return r6(out, "peak_value", "peak_pred_raw", "error_raw", "abs_error_raw")
