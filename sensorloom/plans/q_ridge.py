"""What holds for any model, over the published ridge: its fits end at any size, and SQL can state them in closed form.

The ridge comes from sufficient statistics (`models.ridge`): one scan for all folds, penalties and weights.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.models import learn, ridge, search
from sensorloom.operators import metrics as M
from sensorloom.plans import modelling as G
from sensorloom.plans.q_models import PEAK_PARTS, store, training_rows
from sensorloom.plans.q_response import r6
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import ctes, r
from sensorloom.session import durable, scratch_dir

PERIOD = (
    "CASE WHEN hour(ds.ts) BETWEEN 5 AND 9 THEN 'breakfast' WHEN hour(ds.ts) BETWEEN 10 AND 12 THEN 'mid_morning'"
    " WHEN hour(ds.ts) BETWEEN 13 AND 15 THEN 'lunch' WHEN hour(ds.ts) BETWEEN 16 AND 18 THEN 'snack'"
    " WHEN hour(ds.ts) BETWEEN 19 AND 22 THEN 'dinner' ELSE 'night' END"
)


def code_sql(label: str) -> str:
    return f"dense_rank() OVER (ORDER BY coalesce({label}, 'unknown')) - 1"


# features that the joined tables do not have under their name
FEATURE_SQL = {
    "day_of_week": "isodow(ds.ts) - 1",
    "is_weekend": "CASE WHEN isodow(ds.ts) >= 6 THEN 1 ELSE 0 END",
    "meal_period_enc": code_sql(PERIOD),
    "meal_type_enc": code_sql("ds.meal_type"),
    "sport_prior_intensity_enc": code_sql("ds.sport_prior_intensity"),
    "net_carbs": "greatest(total_carbs - coalesce(total_fibre, 0), 0)",
    "pct_high_gi_items": "n_high_gi / nullif(n_items, 0)",
    "fat_delay_score": "total_fat * total_carbs",
    "effective_gi_score": "n_high_gi * (1 - least(greatest(coalesce(pct_cal_fat, 0) / 100, 0), 1))",
    "carbs_per_item": "total_carbs / nullif(n_items, 0)",
    "user_peak_mean_roll": "CASE WHEN rm.n >= 3 THEN pm END",
    "user_peak_std_roll": "CASE WHEN rm.n >= 3 THEN ps END",
    "user_ttp_mean_roll": "CASE WHEN rm.n >= 3 THEN tm END",
    "user_glucose_mean_roll": "CASE WHEN rg.n >= 10 THEN gm END",
    "user_glucose_std_roll": "CASE WHEN rg.n >= 10 THEN gs END",
    "fat_carb_ratio_meal": "coalesce(total_fat / nullif(total_carbs, 0), 0)",
    "gi_fiber_interaction": "n_high_gi * (1 - least(greatest(coalesce(fibre_carb_ratio, 0), 0), 1))",
    "sport_2h_insulin_proxy": "coalesce(sport_2h_duration, 0) * coalesce(sport_intensity_score, 0)",
}
# answers that the given tables do not have
ABSENT = {
    "tiredness", "fasting_hunger", "resting_hr_morning", "hrv_morning", "nutrition_plan_prev", "day_eval_prev",
}


# all columns of the peak feature table, under their names or as in FEATURE_SQL
JOINED = (
    " FROM ds JOIN (SELECT * EXCLUDE (user_id, ts, us, carbs, meal_type) FROM prew) p USING (meal_id)"
    " LEFT JOIN rm USING (meal_id) LEFT JOIN rg USING (meal_id) JOIN sd USING (meal_id)"
)


def features(production: bool = True, late: bool = False) -> list[str]:
    """The feature list of `pipeline.feature_columns` on the given tables."""
    pre = fixed.PRE_BEST_FEATURES if production else fixed.PRE_FEATURES
    wanted = [
        *fixed.BASE_FEATURES, *[f"{c}_enc" for c in fixed.CATEGORICAL_FEATURES], *pre, *fixed.NUTRITION_FEATURES,
        *fixed.SPORT_FEATURES, *fixed.ROLLING_FEATURES, *fixed.DAY_FEATURES, *(fixed.LATE_FEATURES if late else []),
    ]
    return [c for c in wanted if c not in ABSENT]


def table_parts(columns: list[str], target: str, where: str) -> dict[str, str]:
    """The training table `tr`: features filled by the user's median, the median of all and 0, label `y`, and `fold`."""
    every = {
        **PEAK_PARTS,
        "ft": "SELECT ds.meal_id, ds.user_id, ds.ts, ds.peak_value, ds.time_to_peak_min, ds.iauc, "
        + ", ".join(f"CAST({FEATURE_SQL.get(c, c)} AS DOUBLE) AS f_{c}" for c in columns)
        + JOINED,
        "fl": f"SELECT * FROM ft WHERE {where}",
        "u1": "SELECT meal_id, user_id, ts, " + f"CAST({target} AS DOUBLE) AS y, "
        + ", ".join(f"coalesce(f_{c}, median(f_{c}) OVER (PARTITION BY user_id)) AS f_{c}" for c in columns) + " FROM fl",
        "md": "SELECT " + ", ".join(f"median(f_{c}) AS m_{c}" for c in columns) + " FROM u1",
        "us": "SELECT user_id, count(*) AS n FROM u1 GROUP BY user_id",
        "ud": "SELECT user_id, (row_number() OVER (ORDER BY n DESC, md5('folds:' || user_id), user_id) - 1) % 10 AS t FROM us",
        "tr": "SELECT meal_id, user_id, ts, y, CASE WHEN t < 5 THEN t ELSE 9 - t END AS fold, "
        + ", ".join(f"coalesce(f_{c}, m_{c}, 0) AS f_{c}" for c in columns) + " FROM u1 JOIN ud USING (user_id), md",
    }
    return {n: body for n, body in every.items() if n != "pk"}


def solve_parts(columns: list[str], alpha: str = "1.0", weight: str = "1.0", rows: str = "tr", name: str = "oof",
                by: str = "(SELECT DISTINCT fold AS held FROM tr)") -> dict[str, str]:
    """Closed form: for each `held` fold the normal equations of the other folds, solved by elimination, and its predictions.

    Columns are put in units of their spread first; place 0 is the intercept. `by` gives the held folds (-1: none).
    """
    p = len(columns)
    n = name
    return {
        f"{n}_st": "SELECT " + ", ".join(f"avg(f_{c}) AS a_{c}, coalesce(nullif(stddev_pop(f_{c}), 0), 1) AS s_{c}" for c in columns) + f" FROM {rows}",
        f"{n}_z": f"SELECT meal_id, fold, y, {weight} AS w, [1.0::DOUBLE, " + ", ".join(f"(f_{c} - a_{c}) / s_{c}" for c in columns)
        + f", y] AS z FROM {rows}, {n}_st",
        f"{n}_l": f"SELECT meal_id, fold, w, unnest(z) AS v, generate_subscripts(z, 1) AS i FROM {n}_z",
        f"{n}_g": f"SELECT a.fold, a.i, b.i AS j, sum(a.w * a.v * b.v) AS g FROM {n}_l a JOIN {n}_l b USING (meal_id) WHERE a.i <= {p + 1} GROUP BY ALL",
        f"{n}_pen": "SELECT unnest([0.0::DOUBLE, " + ", ".join(f"1 / (s_{c} * s_{c})" for c in columns) + f"]) AS pen, unnest(range(1, {p + 2})) AS i FROM {n}_st",
        f"{n}_sys": f"SELECT held, alpha, i, list(g ORDER BY j) AS row FROM (SELECT held, alpha, g.i, j,"
        f" sum(g) + CASE WHEN g.i = j THEN alpha * any_value(pen) ELSE 0 END AS g FROM {n}_g g JOIN {n}_pen USING (i) JOIN {by} h ON g.fold <> h.held,"
        f" (SELECT unnest([{alpha}]::DOUBLE[]) AS alpha) GROUP BY held, alpha, g.i, j) GROUP BY held, alpha, i",
        f"{n}_m": f"SELECT held, alpha, 0 AS k, list(row ORDER BY i) AS m FROM {n}_sys GROUP BY held, alpha"
        " UNION ALL SELECT held, alpha, k + 1, [CASE WHEN i = k + 1 THEN [x / m[k + 1][k + 1] for x in m[k + 1]]"
        " ELSE [m[i][j] - m[i][k + 1] / m[k + 1][k + 1] * m[k + 1][j] for j in range(1, len(m[i]) + 1)] END for i in range(1, len(m) + 1)]"
        f" FROM {n}_m WHERE k < {p + 1}",
        f"{n}_b": f"SELECT held, alpha, [x[{p + 2}] for x in m] AS b FROM {n}_m WHERE k = {p + 1}",
        n: f"SELECT t.* EXCLUDE (" + ", ".join(f"f_{c}" for c in columns) + f"), alpha, list_dot_product(z.z[1 : {p + 1}], b) AS p"
        f" FROM {rows} t JOIN {n}_z z USING (meal_id) JOIN {n}_b o ON o.held IN (-1, t.fold)",
    }


PEAK_ROWS = table_parts(features(), "peak_value", "peak_value > 0")
FIRST_ROWS = table_parts(features(False), "peak_value", "peak_value > 0")


def with_sql(parts: dict[str, str]) -> str:
    return ctes("readings", "meals", "sport", "answers", "nutrition", extra=parts).replace("WITH ", "WITH RECURSIVE ", 1)


OOF = {**PEAK_ROWS, **solve_parts(features())}
FOLDS_SQL = (
    "SELECT fold, count(*) AS n, avg(abs(y - {p})) AS mae, sqrt(avg(pow(y - {p}, 2))) AS rmse,"
    " 1 - sum(pow(y - {p}, 2)) / (var_pop(y) * count(*)) AS r2 FROM {t} GROUP BY fold"
)


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in columns})


@query(
    "m07_ridge",
    with_sql({**FIRST_ROWS, **solve_parts(features(False))})
    + f"SELECT CAST(fold AS INTEGER) AS fold, n, {r('mae', 4)} AS mae, {r('rmse', 4)} AS rmse, {r('r2', 4)} AS r2 FROM ({FOLDS_SQL.format(p='p', t='oof')})",
)
def ridge_folds(spark, sf_dir):
    rows, columns = training_rows(spark, sf_dir, "peak_first")
    return rounded(M.regression_by_fold(ridge.out_of_fold(rows, columns, ["meal_id"])), "mae", "rmse", "r2")


def oof(spark, sf_dir) -> DataFrame:
    """Out-of-fold predictions of the ridge on the production features, stored."""

    def make():
        rows, columns = training_rows(spark, sf_dir, "peak")
        return ridge.out_of_fold(rows, columns, ["meal_id", "user_id"]), None

    return store(spark, sf_dir).table("ridge_oof", make)[0]


@query(
    "m13_out_of_fold",
    with_sql(OOF) + f"SELECT meal_id, user_id, CAST(fold AS INTEGER) AS fold, {r('y', 4)} AS label, {r('p', 4)} AS prediction,"
    f" {r('p - y', 4)} AS error, {r('abs(p - y)', 4)} AS abs_error FROM oof",
)
def out_of_fold(spark, sf_dir):
    return rounded(M.with_errors(oof(spark, sf_dir)), "label", "prediction", "error", "abs_error")


WEIGHTS = (
    "SELECT user_id, least(greatest(avg(abs(p - y)) / (SELECT avg(abs(p - y)) FROM oof), 0.5), 3.0) AS uw FROM oof GROUP BY user_id"
)
HEAVIER = {
    **OOF, "uw": WEIGHTS, "wt": "SELECT tr.*, uw FROM tr JOIN uw USING (user_id)",
    **solve_parts(features(), weight="uw", rows="wt", name="again"),
}


def means_sql(name: str, table: str, extra: str) -> str:
    return (
        f"SELECT '{name}' AS model, {r('avg(mae)', 4)} AS mae, {r('avg(rmse)', 4)} AS rmse, {r('avg(r2)', 4)} AS r2, '{extra}' AS changes"
        f" FROM ({FOLDS_SQL.format(p='p', t=table)})"
    )


@query("m16_weighted_fit", with_sql(HEAVIER) + means_sql("plain", "oof", "") + " UNION ALL " + means_sql("weighted", "again", "weights"))
def weighted(spark, sf_dir):
    plain = oof(spark, sf_dir)
    rows, columns = training_rows(spark, sf_dir, "peak")
    weights = M.user_weights(M.with_errors(plain)).select("user_id", "weight")
    heavier = durable(rows.join(weights, "user_id"))
    again = ridge.out_of_fold(heavier, columns, ["meal_id"], weight="weight")
    both = G.result_row(spark, "plain", plain).unionByName(G.result_row(spark, "weighted", again, "weights"))
    return rounded(both, "mae", "rmse", "r2")


ISOTONIC = {
    "pt": "SELECT p AS x, avg(y) AS y, count(*) AS w, row_number() OVER (ORDER BY p) AS i FROM oof GROUP BY p",
    "cum": "SELECT i, x, sum(w) OVER (ORDER BY i) AS cw, sum(w * y) OVER (ORDER BY i) AS cy, w, w * y AS wy FROM pt",
    # the least mean from a on, of all that begin at a and reach i at least; the greatest of these over a
    "mn": "SELECT a.i AS a, b.i, min((b.cy - a.cy + a.wy) / (b.cw - a.cw + a.w)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS least FROM cum a JOIN cum b ON b.i >= a.i",
    "iso": "SELECT i, max(least) AS fit FROM mn GROUP BY i",
}


@query(
    "m18_isotonic",
    with_sql({**OOF, **ISOTONIC}) + f"SELECT meal_id, CAST(oof.fold AS INTEGER) AS fold, {r('oof.y', 4)} AS label, {r('oof.p', 4)} AS prediction, {r('fit', 4)} AS calibrated"
    " FROM oof JOIN pt ON pt.x = oof.p JOIN iso USING (i)",
)
def isotonic(spark, sf_dir):
    """Spark's own fit pools adjacent violators in each score range first and brings the pooled blocks together."""
    predictions = oof(spark, sf_dir)
    made = learn.calibrate(learn.fit_isotonic(predictions), predictions)
    return rounded(made.select("meal_id", "fold", "label", "prediction", "calibrated"), "label", "prediction", "calibrated")


IAUC = [
    c for c in [*fixed.BASE_FEATURES, *fixed.USER_FEATURES, *[f"{c}_enc" for c in fixed.CATEGORICAL_FEATURES], *fixed.INTERACTION_FEATURES]
    if c not in ABSENT and "cluster" not in c
]
IAUC_SQL = FEATURE_SQL | {
    "net_carbs": "total_carbs - coalesce(total_fibre, 0)",
    "carbs_x_hour": "total_carbs * hour_of_day",
    "carbs_x_preprandial": "total_carbs * coalesce(glucose_preprandial, (SELECT median(glucose_preprandial) FROM ds))",
    "fat_protein_ratio": "coalesce(total_fat / nullif(total_protein, 0), (SELECT median(total_fat / nullif(total_protein, 0)) FROM ds))",
}
IAUC_ROWS = {
    **{n: body for n, body in PEAK_PARTS.items() if n != "pk"},
    "u1": "SELECT meal_id, user_id, ts, iauc, " + ", ".join(f"CAST({IAUC_SQL.get(c, c)} AS DOUBLE) AS f_{c}" for c in IAUC) + " FROM ds",
    **{n: PEAK_ROWS[n] for n in ("md", "us", "ud")},
    "md": "SELECT " + ", ".join(f"median(f_{c}) AS m_{c}" for c in IAUC) + " FROM u1",
    "tr": "SELECT meal_id, user_id, iauc, ln(1 + greatest(iauc, 0)) AS y, CASE WHEN t < 5 THEN t ELSE 9 - t END AS fold, "
    + ", ".join(f"coalesce(f_{c}, m_{c}) AS f_{c}" for c in IAUC) + " FROM u1 JOIN ud USING (user_id), md",
    **solve_parts(IAUC),
    "back": "SELECT * EXCLUDE (y, p), iauc AS y, greatest(exp(p) - 1, 0) AS p FROM oof",
}


@query(
    "m14_log_ridge",
    # the way back from logs has a wide range: six digits of each number
    with_sql(IAUC_ROWS) + f"SELECT printf('%.5e', avg(b.mae)) AS mae, printf('%.5e', avg(b.rmse)) AS rmse, printf('%.5e', avg(b.r2)) AS r2, {r('avg(l.r2)', 4)} AS r2_log"
    f" FROM ({FOLDS_SQL.format(p='p', t='back')}) b JOIN ({FOLDS_SQL.format(p='p', t='oof')}) l USING (fold)",
)
def log_ridge(spark, sf_dir):
    """The incremental area on the log scale and back, over the first models' features."""
    rows, columns = training_rows(spark, sf_dir, "iauc")
    logged = rows.withColumn("log_label", C.log_floor("label"))
    found = durable(ridge.out_of_fold(logged, columns, ["meal_id", "label"], label="log_label").withColumnRenamed("prediction", "prediction_log"))
    back = found.withColumn("prediction", C.unlog_floor("prediction_log"))
    on_log = M.regression_metrics(back, "log_label", "prediction_log").select("r2").scalar()
    digits = [F.format_string("%.5e", F.col(c)).alias(c) for c in ("mae", "rmse", "r2")]
    return rounded(M.regression_metrics(back).select(*digits, on_log.alias("r2_log")), "r2_log")


TIME_ROWS = table_parts(features(), "time_to_peak_min", "time_to_peak_min > 0 AND time_to_peak_min <= 180")
CASCADE = ["pred_time_to_peak", "pred_ttp_category"]


def renamed(parts: dict[str, str], names: list[str], suffix: str) -> dict[str, str]:
    """The same parts with other names for some of them."""
    pattern = re.compile(r"\b(" + "|".join(names) + r")\b")
    return {pattern.sub(lambda m: m[0] + suffix, n): pattern.sub(lambda m: m[0] + suffix, body) for n, body in parts.items()}


SECOND = renamed(
    {**{n: TIME_ROWS[n] for n in ("fl", "u1", "md", "us", "ud", "tr")}, **solve_parts(features())},
    ["fl", "u1", "md", "us", "ud", "tr", *solve_parts(features())], "_t",
)
STACKED = {
    **OOF, **SECOND,
    "st": "SELECT tr.*, oof_t.p AS f_pred_time_to_peak, CAST(CASE WHEN oof_t.p < 45 THEN 0 WHEN oof_t.p <= 75 THEN 1 ELSE 2 END AS DOUBLE)"
    " AS f_pred_ttp_category FROM tr JOIN (SELECT meal_id, p FROM oof_t) oof_t USING (meal_id)",
    **solve_parts([*features(), *CASCADE], rows="st", name="stk"),
}


@query(
    "m19_cascade",
    with_sql(STACKED) + means_sql("alone", "oof", "") + " UNION ALL " + means_sql("cascade", "stk", "time to peak"),
)
def cascade(spark, sf_dir):
    times, columns = training_rows(spark, sf_dir, "time")
    second = durable(ridge.out_of_fold(times, columns, ["meal_id"]))
    rows, columns = training_rows(spark, sf_dir, "peak")
    stacked = durable(learn.with_cascade(rows, second))
    stacked_oof = ridge.out_of_fold(stacked, [*columns, *CASCADE], ["meal_id"])
    both = G.result_row(spark, "alone", oof(spark, sf_dir)).unionByName(G.result_row(spark, "cascade", stacked_oof, "time to peak"))
    return rounded(both, "mae", "rmse", "r2")


@query(
    "s06_model_round_trip",
    with_sql({**PEAK_ROWS, **solve_parts(features(), by="(SELECT -1 AS held)", name="whole")})
    + f"SELECT meal_id, {r('y', 2)} AS label, {r('p', 2)} AS prediction FROM whole",
)
def round_trip(spark, sf_dir):
    """Fitted on all rows, written with its feature list, read again and applied."""
    rows, columns = training_rows(spark, sf_dir, "peak")
    model = store(spark, sf_dir).model("ridge_peak", lambda: learn.fit_pipeline(rows, learn.ridge(), columns))
    assert learn.feature_order(model) == columns
    return rounded(model.transform(rows).select("meal_id", "label", "prediction"), "label", "prediction", digits=2)


ALPHAS = search.log_draws(1e-2, 1e4, 50)
FOLD_BUDGETS = (1, 3, 5)
TRIALS = {
    **PEAK_ROWS, **solve_parts(features(), alpha=", ".join(map(repr, ALPHAS))),
    "sc": "SELECT alpha, fold, avg(abs(y - p)) AS mae FROM oof GROUP BY alpha, fold",
    "dr": f"SELECT unnest([{', '.join(map(repr, ALPHAS))}]::DOUBLE[]) AS alpha, unnest(range({len(ALPHAS)})) AS draw",
    "r0": "SELECT draw, avg(mae) AS s, row_number() OVER (ORDER BY avg(mae), draw) AS place FROM sc JOIN dr USING (alpha) WHERE fold < 1 GROUP BY draw",
    "r1": "SELECT draw, avg(mae) AS s, row_number() OVER (ORDER BY avg(mae), draw) AS place FROM sc JOIN dr USING (alpha) WHERE fold < 3"
    " AND draw IN (SELECT draw FROM r0 WHERE place <= 17) GROUP BY draw",
    "r2": "SELECT draw, avg(mae) AS s, row_number() OVER (ORDER BY avg(mae), draw) AS place FROM sc JOIN dr USING (alpha) WHERE fold < 5"
    " AND draw IN (SELECT draw FROM r1 WHERE place <= 6) GROUP BY draw",
}


@query(
    "m17_search",
    with_sql(TRIALS) + " UNION ALL ".join(
        f"SELECT {i} AS rung, CAST(draw AS INTEGER) AS draw, {folds} AS n_folds, {r('s', 4)} AS score, CAST(place AS INTEGER) AS place, place <= {keep} AS goes_on FROM r{i}"
        for i, (folds, keep) in enumerate(zip(FOLD_BUDGETS, (17, 6, 1)))
    ),
)
def penalties(spark, sf_dir):
    """50 penalties, halved over one, three and all folds."""
    rows, columns = training_rows(spark, sf_dir, "peak")
    scores = search.ridge_scores(rows, columns, ALPHAS)
    trials = search.halving(rows, len(ALPHAS), FOLD_BUDGETS, scores, f"{scratch_dir(spark)}/search")
    return rounded(trials, "score").select("rung", "draw", "n_folds", "score", "place", "goes_on")
