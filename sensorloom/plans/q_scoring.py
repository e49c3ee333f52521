"""Scoring requests: feature rows, advice and expected curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.functions.curve import curve_points
from sensorloom.operators.profiles import default_row
from sensorloom.operators.scoring import feature_rows
from sensorloom.plans import q_ridge as Q
from sensorloom.plans.q_metrics import PRED, predictions
from sensorloom.plans.q_models import dataset
from sensorloom.plans.q_nutrition import nutrition
from sensorloom.plans.q_response import PARTS, r6, responses
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import CTES, ctes, r
from sensorloom.sources import roles

PRIORITY_PERIOD = {
    "1-URGENT": "Desayuno", "2-HIGH": "Media mañana", "3-MEDIUM": "Almuerzo", "4-NOT SPECIFIED": "Merienda", "5-LOW": "Cena",
}
STATUS_SLOPE = {"F": 0.15, "O": -0.15, "P": 0.007}


def requests(spark, sf_dir):
    """One scoring request per order with items."""
    customer = F.col("o_custkey")
    o = roles.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("meal_id"),
        (F.col("o_totalprice") / 5000 + 60).alias("glucose_preprandial"),
        F.coalesce(
            *[F.when(F.col("o_orderstatus") == s, F.lit(v)) for s, v in STATUS_SLOPE.items()]
        ).alias("cgm_slope"),
        (F.pmod(customer, F.lit(3)) * 20).alias("sport_2h"),
        (F.pmod(customer, F.lit(5)) * 15).alias("sport_6h"),
        (F.pmod(customer, F.lit(3)) + 1).alias("sport_intensity"),
        C.map_values("o_orderpriority", PRIORITY_PERIOD).alias("period"),
    )
    n = nutrition(spark, sf_dir).select(
        "meal_id", F.col("total_carbs").alias("carbs"), F.col("total_fat").alias("fat"),
        F.col("total_protein").alias("protein"), F.col("total_fibre").alias("fibre"), "n_items", "n_high_gi",
        "n_ultraprocessed", F.col("avg_saturated_fat").alias("avg_sat_fat"),
    )
    return o.join(n, "meal_id")


REQ = {
    "raw_items": CTES["raw_items"], "items": CTES["items"], "foods": CTES["foods"], "nutr": CTES["nutr"],
    "req": "SELECT n.*, n.total_carbs AS carbs, n.total_fat AS fat, n.total_protein AS protein, n.total_fibre AS fibre,"
    " o_totalprice / 5000 + 60 AS g0, CASE o_orderstatus "
    + " ".join(f"WHEN '{s}' THEN {v}" for s, v in STATUS_SLOPE.items())
    + " END AS slope, (o_custkey % 3) * 20 AS sport_2h, (o_custkey % 3) + 1 AS si, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN {fixed.MEAL_PERIOD_HOURS[n]}" for p, n in PRIORITY_PERIOD.items())
    + " END AS hr, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN {fixed.MEAL_PERIOD_CODES[n]}" for p, n in PRIORITY_PERIOD.items())
    + " END AS pc, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN {fixed.MEAL_TYPE_CODES[n]}" for p, n in PRIORITY_PERIOD.items())
    + " END AS tc, (o_custkey % 5) * 15 AS sport_6h, greatest(total_protein * 4 + total_fat * 9 + total_carbs * 4, 1.0) AS kcal"
    " FROM nutr n JOIN orders ON o_orderkey = meal_id",
}
WANTED = {
    "glucose_preprandial": "g0", "total_calories": "kcal", "pct_cal_carbs": "carbs * 4 / kcal * 100",
    "fibre_carb_ratio": "CASE WHEN carbs > 0 THEN fibre / carbs ELSE 0 END", "net_carbs": "greatest(carbs - fibre, 0)",
    "effective_gi_score": "n_high_gi * (1 - fat * 9 / kcal)", "hour_of_day": "hr", "meal_period_enc": "pc",
    "cgm_delta_90m": "slope * 90", "cgm_tir_pre": "CASE WHEN g0 BETWEEN 70 AND 140 THEN 100 ELSE 0 END",
    "sport_2h_insulin_proxy": "sport_2h * si", "fat_carb_ratio_meal": "CASE WHEN carbs > 0 THEN fat / carbs ELSE 0 END",
    "glucose_2h": "(SELECT median(glucose_2h) FROM resp)", "recovery_time_min": "(SELECT median(recovery_time_min) FROM resp)",
    "never_seen": "0",
}


# columns of the feature table that are no feature of the production models
OTHER_NUMERIC = [
    *fixed.TARGETS, *fixed.USER_FEATURES, "n_sugar_added", "cgm_slope_60m", "cgm_delta_60m", "cgm_window_used",
]
FEATURES = Q.features(late=True)
NUMERIC = list(dict.fromkeys([*OTHER_NUMERIC, *FEATURES]))
# stand-ins take the place of these medians
STOOD_IN = {c: (other, fixed.STAND_INS[c]) for c, other in fixed.STAND_IN_OF.items()}


def default_parts() -> dict[str, str]:
    """`dr`: one row with the default of each numeric column."""
    ratio = {"fat_carb_ratio_meal": "total_fat / nullif(total_carbs, 0)"}
    columns = {c: Q.FEATURE_SQL.get(c, c) for c in NUMERIC} | {"n_sugar_added": "0"} | ratio
    parts = {n: body for n, body in Q.PEAK_PARTS.items() if n != "pk"}
    parts["nums"] = "SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in columns.items()) + Q.JOINED
    parts["dr"] = "SELECT " + ", ".join(
        f"coalesce(median({STOOD_IN[c][0]}), {STOOD_IN[c][1]}) AS {c}" if c in STOOD_IN else f"median({c}) AS {c}" for c in NUMERIC
    ) + " FROM nums"
    return parts


DEFAULTS = default_parts()
# what a request says or implies
STATED = {
    "glucose_preprandial": "g0", "total_calories": "kcal", "total_protein": "protein", "total_fat": "fat", "total_carbs": "carbs",
    "total_fibre": "fibre", "n_items": "req.n_items", "n_high_gi": "req.n_high_gi", "n_ultraprocessed": "req.n_ultraprocessed",
    "avg_saturated_fat": "req.avg_saturated_fat", "pct_cal_carbs": "carbs * 4 / kcal * 100", "pct_cal_protein": "protein * 4 / kcal * 100",
    "pct_cal_fat": "fat * 9 / kcal * 100", "fibre_carb_ratio": "CASE WHEN carbs > 0 THEN fibre / carbs ELSE 0 END",
    "net_carbs": "greatest(carbs - fibre, 0)", "pct_high_gi_items": "coalesce(req.n_high_gi / nullif(req.n_items, 0), 0)",
    "fat_delay_score": "fat * carbs", "effective_gi_score": "req.n_high_gi * (1 - fat * 9 / kcal)",
    "carbs_per_item": "coalesce(carbs / nullif(req.n_items, 0), carbs)", "hour_of_day": "hr", "meal_period_enc": "pc", "meal_type_enc": "tc",
    **{f"cgm_slope_{w}": "slope" for w in ("best", "30m", "90m")},
    **{f"cgm_delta_{w}": f"slope * {m}" for w, m in (("best", 60), ("30m", 30), ("90m", 90))},
    "cgm_tir_pre": "CASE WHEN g0 BETWEEN 70 AND 140 THEN 100 ELSE 0 END", "cgm_pct_above_target": "CASE WHEN g0 > 140 THEN 100 ELSE 0 END",
    "n_readings_pre_60m": "12", "sport_2h_duration": "sport_2h", "sport_6h_duration": "sport_6h", "sport_intensity_score": "si",
    "sport_2h_insulin_proxy": "sport_2h * si", "fat_carb_ratio_meal": "CASE WHEN carbs > 0 THEN fat / carbs ELSE 0 END",
    "gi_fiber_interaction": "req.n_high_gi * (1 - least(greatest(coalesce(CASE WHEN carbs > 0 THEN fibre / carbs END, 0), 0), 1))",
}
WANTED = [*FEATURES, "glucose_2h", "recovery_time_min", "never_seen"]


def places(name: str) -> int:
    """A quotient by 8 or 16 items ends on a 5 at the seventh digit or so."""
    return 9 if name == "carbs_per_item" else 6


def wanted_sql(name: str) -> str:
    if name in STATED:
        return f"coalesce({STATED[name]}, 0)"
    return f"coalesce((SELECT {name} FROM dr), {fixed.STAND_INS.get(name, 0) if name in fixed.SPREADS else 0})" if name in NUMERIC else "0"


@query(
    "e23_feature_rows",
    ctes("readings", "meals", "sport", "answers", "nutrition", extra={**DEFAULTS, **{n: REQ[n] for n in ("req",)}})
    + "SELECT meal_id, " + ", ".join(f"{r(wanted_sql(n), places(n))} AS {n}" for n in WANTED) + " FROM req",
)
def features(spark, sf_dir):
    """The whole feature list, for each request."""
    rows = feature_rows(requests(spark, sf_dir), default_row(dataset(spark, sf_dir)), WANTED)
    return rows.withColumns({c: F.round(c, places(c)) + F.lit(0.0) for c in WANTED})


@query(
    "a28_default_row",
    ctes("readings", "meals", "sport", "answers", "nutrition", extra=DEFAULTS)
    + "SELECT " + ", ".join(f"{r(c)} AS {c}" for c in NUMERIC) + " FROM dr",
)
def defaults(spark, sf_dir):
    """Every numeric column of the feature table, and the codes of its categories."""
    return r6(default_row(dataset(spark, sf_dir)), *NUMERIC).select(*NUMERIC)


@query(
    "e20_advice",
    ctes("raw_items", "items", "foods", "nutr") + PRED.replace("WITH ", ", ", 1)
    + "SELECT meal_id, concat_ws(',', CASE WHEN prediction > 160 THEN 'high_peak' WHEN prediction > 140 THEN 'raised_peak'"
    " ELSE 'in_range' END, CASE WHEN p > 0.65 THEN 'late_activity' WHEN p < 0.35 THEN 'no_hard_exercise' END,"
    " CASE WHEN total_fibre / greatest(total_carbs, 1) < 0.15 AND total_carbs > 40 THEN 'add_fibre' END) AS advice"
    " FROM pred JOIN nutr USING (meal_id)",
)
def advice(spark, sf_dir):
    df = predictions(spark, sf_dir).join(nutrition(spark, sf_dir), "meal_id")
    label = C.ttp_label("p", closed=True, cut=0.40)
    lines = C.advice("prediction", label, F.col("total_carbs"), F.col("total_fibre"))
    return df.select("meal_id", F.concat_ws(",", lines).alias("advice"))


RISE_N = "greatest(m, 20)"
CURVE_SQL = (
    PRED + ", q AS (SELECT meal_id, coalesce(glucose_preprandial, 100.0) AS g, round(prediction, 9) AS pk,"
    " CASE WHEN p > 0.65 THEN 90 WHEN p < 0.35 THEN 35 ELSE 60 END AS m FROM pred),"
    " s AS (SELECT *, 8.0 / m AS k, 1 / (1 + exp(8.0 / m * 0.45 * m)) AS s0, 1 / (1 + exp(-8.0 / m * 0.55 * m)) AS s1 FROM q),"
    " c AS (SELECT meal_id, -30 + 30.0 * i / 29 AS minute, g AS value FROM q, range(0, 30) t(i)"
    f" UNION ALL SELECT meal_id, m * i / ({RISE_N} - 1)::DOUBLE, g + (pk - g) * ((1 / (1 + exp(-k * (m * i / ({RISE_N} - 1)::DOUBLE"
    f" - 0.45 * m))) - s0) / (s1 - s0)) FROM s, range(1, 100) t(i) WHERE i < {RISE_N}"
    " UNION ALL SELECT meal_id, m + 120.0 * i / 119, pk + (g - pk) * (1 - exp(ln(0.1) / 120 * (120.0 * i / 119)))"
    f" FROM q, range(1, 120) t(i)) SELECT meal_id, {r('minute')} AS minute, {r('value')} AS value FROM c"
)


@query("e25_curve_points", CURVE_SQL)
def curves(spark, sf_dir):
    df = predictions(spark, sf_dir).select(
        "meal_id", F.coalesce("glucose_preprandial", F.lit(100.0)).alias("g"),
        F.round("prediction", 9).alias("prediction"),  # a mean over 2^n rows may end on a 5 at the seventh digit
        C.ttp_minutes("p").alias("m"),
    )
    return r6(curve_points(df, "g", "prediction", "m").select("meal_id", "minute", "value"), "minute", "value")
