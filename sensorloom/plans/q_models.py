"""Feature tables, clusters, and tree models with the published settings, which are the library's defaults.

Fits of trees are no SQL: these are checked by invariants. Stages are kept in a store (`sources.store`) that
knows them again by their inputs, settings and code. What holds for any model runs over the ridge in `q_ridge`.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.models import cluster, learn
from sensorloom.operators import metrics as M
from sensorloom.operators.folds import zscore
from sensorloom.operators.profiles import nutrition_profile, response_profile
from sensorloom.plans import modelling as G
from sensorloom.plans import pipeline
from sensorloom.plans.q_context import ACT_PARTS, ROLL_PARTS, digits
from sensorloom.plans.q_response import PARTS, PRE_SQL
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import K, ctes, r
from sensorloom.session import durable, scratch_dir
from sensorloom.sources import roles
from sensorloom.sources.store import Store

INPUTS = ("events", "lineitem", "part")


def store(spark, sf_dir) -> Store:
    return Store(spark, sf_dir, INPUTS, scale=roles.SCALE, folds=G.K)


def dataset(spark, sf_dir) -> DataFrame:
    """The peak feature table."""

    def make():
        t = roles.domain(spark, sf_dir)
        base = durable(pipeline.modeling_dataset(t, roles.SCALE))
        return pipeline.peak_dataset(base, t, roles.SCALE), None

    return store(spark, sf_dir).table("modeling_dataset_peak", make)[0]


TABLES = {
    "peak_first": lambda df: G.peak_table(df, production=False),
    "peak": G.peak_table,
    "time": G.time_table,
    "late": G.late_table,
    "iauc": G.iauc_table,
}


def training_rows(spark, sf_dir, kind: str) -> tuple[DataFrame, list[str]]:
    """Training table and the feature names."""
    return store(spark, sf_dir).table(f"train_{kind}", lambda: TABLES[kind](dataset(spark, sf_dir)))


def training(spark, sf_dir, kind: str) -> tuple[DataFrame, list[str]]:
    """Training table with its feature vector, and the feature names."""
    rows, columns = training_rows(spark, sf_dir, kind)
    return learn.assemble(rows, columns), columns


SLEEP_SQL = (
    "SELECT *, CAST(ts AS DATE) AS d, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, id) AS rn FROM answers"
)
DATASET_PARTS = {
    # meals that have items, in place of all
    "meals": "SELECT event_id AS meal_id, user_id, ts, epoch_us(ts) AS us, value AS carbs,"
    f" ['main', 'snack', 'drink'][{K} % 3 + 1] AS meal_type FROM events WHERE event_type = 'purchase'"
    " AND event_id IN (SELECT l_orderkey FROM lineitem)",
    **PARTS,
    **ACT_PARTS,
    "ans": SLEEP_SQL,
    "ust": "SELECT user_id, avg(r_value) AS user_glucose_mean, stddev_samp(r_value) AS user_glucose_std,"
    " median(r_value) AS user_glucose_median, quantile_cont(r_value, 0.25) AS user_glucose_q25,"
    " quantile_cont(r_value, 0.75) AS user_glucose_q75,"
    " avg(CASE WHEN r_value BETWEEN 70 AND 140 THEN 100.0 ELSE 0 END) AS user_time_in_range FROM readings GROUP BY user_id",
    "ds": "SELECT r.* EXCLUDE (carbs), m.meal_type, CAST(hour(r.ts) AS INTEGER) AS hour_of_day, a.* EXCLUDE (meal_id, user_id),"
    " s.score AS sleep_time_prev, s.level AS sleep_quality_prev, coalesce(s.flag, false) AS is_sick,"
    " e.score AS training_effort_prev, e.level AS anxiety_prev, coalesce(e.flag, false) AS out_of_routine_prev,"
    " u.* EXCLUDE (user_id), n.* EXCLUDE (meal_id) FROM resp r JOIN meals m USING (meal_id) JOIN act a USING (meal_id)"
    " LEFT JOIN ans s ON s.rn = 1 AND s.user_id = r.user_id AND s.d = CAST(r.ts AS DATE)"
    " LEFT JOIN ans e ON e.rn = 1 AND e.user_id = r.user_id AND e.d = CAST(r.ts AS DATE) - 1"
    " LEFT JOIN ust u ON u.user_id = r.user_id LEFT JOIN nutrition n ON n.meal_id = r.meal_id",
}
DATASET = ctes("readings", "meals", "sport", "answers", "nutrition", extra=DATASET_PARTS)
DATASET_REAL = (
    "peak_value", "time_to_peak_min", "amplitude", "iauc", "recovery_time_min", "cv_postprandial", "glucose_2h",
    "sport_prior_duration", "hours_since_last_sport", "sport_6h_duration", "sport_intensity_score", "sleep_time_prev",
    "anxiety_prev", "user_glucose_std", "user_glucose_median", "user_time_in_range", "total_calories", "total_fibre",
    "pct_cal_fat", "fibre_carb_ratio", "pct_items_with_fibre",
)
DATASET_PLAIN = (
    "meal_id", "user_id", "n_readings_post", "meal_type", "hour_of_day", "sport_prior_intensity", "is_sick",
    "out_of_routine_prev", "n_items", "n_high_gi", "n_food_groups",
)


def dataset_sql(head: str, table: str, plain, real) -> str:
    return head + "SELECT " + ", ".join([*plain, *[f"{r(c, digits(c))} AS {c}" for c in real]]) + f" FROM {table}"


def rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits(c)) + F.lit(0.0) for c in columns})


@query("j01_modeling_dataset", dataset_sql(DATASET, "ds", DATASET_PLAIN, DATASET_REAL))
def modeling(spark, sf_dir):
    base = pipeline.modeling_dataset(roles.domain(spark, sf_dir), roles.SCALE)
    return rounded(base, DATASET_REAL).select(*DATASET_PLAIN, *DATASET_REAL)


PEAK_PARTS = {
    **DATASET_PARTS,
    **PRE_SQL,
    "rm": ROLL_PARTS["rm"].replace("resp ", "ds "),
    "rg": ROLL_PARTS["rg"].replace("resp ", "ds "),
    "sd": "SELECT a.meal_id, count(b.meal_id) AS prev_meals_today, max(b.peak_value) AS prev_peak_today_max,"
    " (any_value(a.us) - max(b.us)) / 3600000000.0 AS hours_since_last_meal, coalesce(sum(b.total_carbs), 0) AS carbs_load_today"
    " FROM ds a LEFT JOIN ds b ON a.user_id = b.user_id AND CAST(a.ts AS DATE) = CAST(b.ts AS DATE) AND b.us < a.us"
    " GROUP BY a.meal_id",
    "pk": "SELECT ds.*, p.cgm_slope_best, p.cgm_delta_30m, p.cgm_std_90m, p.cgm_tir_pre, p.n_readings_pre_60m, p.cgm_window_used,"
    " greatest(total_carbs - coalesce(total_fibre, 0), 0) AS net_carbs, total_fat * total_carbs AS fat_delay_score,"
    " CASE WHEN rm.n >= 3 THEN pm END AS user_peak_mean_roll, CASE WHEN rm.n >= 3 THEN ps END AS user_peak_std_roll,"
    " CASE WHEN rg.n >= 10 THEN gm END AS user_glucose_mean_roll, sd.prev_meals_today, sd.prev_peak_today_max,"
    " sd.hours_since_last_meal, sd.carbs_load_today, sport_2h_duration * sport_intensity_score AS sport_2h_insulin_proxy"
    " FROM ds JOIN prew p USING (meal_id) LEFT JOIN rm USING (meal_id) LEFT JOIN rg USING (meal_id) JOIN sd USING (meal_id)",
}
PEAK_REAL = (
    "peak_value", "iauc", "cgm_slope_best", "cgm_delta_30m", "cgm_std_90m", "cgm_tir_pre", "net_carbs", "fat_delay_score",
    "user_peak_mean_roll", "user_peak_std_roll", "user_glucose_mean_roll", "prev_peak_today_max", "hours_since_last_meal",
    "carbs_load_today", "sport_2h_insulin_proxy",
)
PEAK_PLAIN = ("meal_id", "user_id", "n_readings_pre_60m", "cgm_window_used", "prev_meals_today")


@query(
    "j01_peak_dataset",
    dataset_sql(ctes("readings", "meals", "sport", "answers", "nutrition", extra=PEAK_PARTS), "pk", PEAK_PLAIN, PEAK_REAL),
)
def peak(spark, sf_dir):
    return rounded(dataset(spark, sf_dir), PEAK_REAL).select(*PEAK_PLAIN, *PEAK_REAL)


@query("m02_user_clusters")
def clusters(spark, sf_dir):
    profiles = G.cluster_profiles(dataset(spark, sf_dir), roles.readings(spark, sf_dir))
    return profiles.select("user_id", "nutri_cluster", "nutri_cluster_name", "glyc_cluster", "glyc_cluster_name")


def _scaled(spark, sf_dir, kind: str):
    df = dataset(spark, sf_dir)
    if kind == "nutrition":
        profile, cols = nutrition_profile(df), fixed.NUTRITION_CLUSTER_INPUTS
    else:
        profile, cols = response_profile(df, roles.readings(spark, sf_dir)), fixed.RESPONSE_CLUSTER_INPUTS
    return durable(zscore(durable(profile), cols)), [f"{c}_z" for c in cols]


@query("m03_cluster_sweep")
def cluster_sweep(spark, sf_dir):
    parts = []
    for kind in ("nutrition", "response"):
        rows, cols = _scaled(spark, sf_dir, kind)
        parts.append(cluster.sweep(rows, cols).withColumn("profile", F.lit(kind)))
    return parts[0].unionByName(parts[1])


@query("a41_silhouette")
def silhouette(spark, sf_dir):
    rows, cols = _scaled(spark, sf_dir, "response")
    fitted = cluster.kmeans(rows, cols, 2)
    return learn.results_table(spark, [(cluster.silhouette(fitted),)], "silhouette double")


def _fold_query(name: str, model, **args):
    @query(name)
    def run(spark, sf_dir):
        rows, _ = training(spark, sf_dir, "peak_first")
        return M.regression_by_fold(learn.out_of_fold(rows, model(), G.K, ["meal_id"], **args))


_fold_query("m08_forest", lambda: learn.forest(), in_tasks=True)
_fold_query("m09_boosted", learn.boosted)


@query("m11_late_or_fast")
def late(spark, sf_dir):
    rows, _ = training(spark, sf_dir, "late")
    oof = learn.out_of_fold(
        rows, learn.boosted_class(weight="weight"), G.K, ["meal_id", "user_id"], probability=True
    )
    scored = oof.withColumn("pred_binary", (F.col("probability") >= 0.5).cast("int"))
    return M.binary_by(scored, ["fold"], "label", "pred_binary")


@query("m12_three_classes")
def three(spark, sf_dir):
    """Over the forest of 200 trees; three boosted models per fold are `learn.three_class`."""
    rows, _ = training(spark, sf_dir, "time")
    classed = durable(rows.withColumn("label", C.time_class("label").cast("double")))
    oof = learn.out_of_fold(classed, learn.forest_class(), G.K, ["meal_id"], in_tasks=True)
    return M.macro_by(oof, ["fold"], "label", "prediction", [0, 1, 2])


@query("m14_log_target")
def log_target(spark, sf_dir):
    rows, _ = training(spark, sf_dir, "iauc")
    out, fitted = None, learn.fold_models(rows, learn.boosted(), G.K, log=True, in_tasks=True)  # both turn the same fits back
    for kind in ("plain", "corrected"):
        preds = durable(learn.out_of_fold(rows, learn.boosted(), G.K, ["meal_id"], log=kind, fitted=fitted))
        both = M.regression_metrics(preds).select(
            F.lit(kind).alias("back_transform"), "mae", "rmse", "r2",
            M.regression_metrics(preds, "_fit_label", "prediction_log").select("r2").scalar().alias("r2_log"),
        )
        out = both if out is None else out.unionByName(both)
    return out


@query("m20_importance")
def importance(spark, sf_dir):
    """Of the forest of 200 trees."""
    rows, cols = training(spark, sf_dir, "peak")
    return learn.importance(learn.forest(), rows, cols)


@query("m22_batch_scoring")
def scoring(spark, sf_dir):
    """Scored by fitted models out of the store: forests, and the calibration of the forest's out-of-fold predictions."""
    df, kept = dataset(spark, sf_dir), store(spark, sf_dir)
    rows, columns = training_rows(spark, sf_dir, "peak")
    late_rows, late_columns = training_rows(spark, sf_dir, "late")

    def out_of_fold():
        return learn.out_of_fold(learn.assemble(rows, columns), learn.forest(), G.K, ["meal_id", "user_id"], in_tasks=True), None

    stages = [
        lambda: kept.model("forest_peak", lambda: learn.fit_pipeline(rows, learn.forest(), columns, in_tasks=True)),
        lambda: kept.model("forest_late", lambda: learn.fit_pipeline(late_rows, learn.forest_class(weight="weight"), late_columns, in_tasks=True)),
        lambda: kept.table("forest_oof", out_of_fold)[0],
    ]
    # none needs another: while models are stored and read by the driver, trees of the next grow
    with ThreadPool(len(stages)) as pool:
        peak_model, late_model, predictions = pool.map(inheritable_thread_target(spark)(lambda stage: stage()), stages)
    every = G.scoring_table(df, list(dict.fromkeys([*columns, *late_columns])))
    scored = learn.score(every, peak_model, learn.fit_isotonic(predictions), late_model)
    return scored.select(
        "meal_id", "peak_raw", "peak_value_predicted", "ttp_probability", "ttp_label", "ttp_minutes", "classification",
        "amplitude_predicted",
    )
