"""Interval and as-of joins, response measures, pre-event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators import response as R
from sensorloom.operators.temporal import (
    as_of, interval_agg, interval_join, plain_interval_join, previous_in_series,
)
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import HOUR, ctes, r
from sensorloom.sources import roles

SCALE = roles.SCALE
UNIT = HOUR


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round doubles for comparison; adding 0.0 drops a negative zero."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) + F.lit(0.0) for c in cols})


def both(spark, sf_dir):
    return roles.meals(spark, sf_dir), roles.readings(spark, sf_dir)


# One WITH chain for all response measures, written the direct way.
PARTS = {
    "pre": f"SELECT m.meal_id, arg_max(g.r_value, g.r_us) AS v, avg(g.r_value) AS v_mean FROM meals m JOIN readings g"
    f" ON g.user_id = m.user_id AND g.r_us BETWEEN m.us - {15 * UNIT} AND m.us GROUP BY m.meal_id",
    "post": f"SELECT m.meal_id, m.us, g.r_us, g.r_value, (g.r_us - m.us) / {float(UNIT)} AS x FROM meals m"
    f" JOIN readings g ON g.user_id = m.user_id AND g.r_us > m.us AND g.r_us <= m.us + {180 * UNIT}",
    "agg": "SELECT meal_id, count(*) AS n, max(r_value) AS peak, (list(r_us ORDER BY r_value DESC, r_us))[1] AS peak_us,"
    " arg_min(r_value, r_us) AS v0, avg(r_value) AS av, stddev_pop(r_value) AS sd,"
    " avg(r_value) FILTER (WHERE x BETWEEN 110 AND 130) AS g2h, any_value(us) AS us FROM post GROUP BY meal_id"
    " HAVING count(*) >= 5",
    "base": "SELECT a.*, p.v, p.v_mean, coalesce(p.v, a.v0) AS b FROM agg a LEFT JOIN pre p USING (meal_id)",
    "steps": "SELECT meal_id, b, peak_us, r_us, r_value, x, greatest(r_value - b, 0) AS y,"
    " lag(x) OVER w AS x0, lag(greatest(r_value - b, 0)) OVER w AS y0 FROM post JOIN base USING (meal_id)"
    " WINDOW w AS (PARTITION BY meal_id ORDER BY r_us)",
    "area": "SELECT meal_id, coalesce(sum((y + y0) / 2 * (x - x0)), 0) AS iauc,"
    " min(r_us) FILTER (WHERE r_us > peak_us AND r_value <= b + 5) AS back_us FROM steps GROUP BY meal_id",
    "resp": "SELECT e.meal_id, m.user_id, m.ts, e.us, m.carbs, e.v AS glucose_preprandial,"
    " e.v_mean AS glucose_preprandial_mean, e.peak AS peak_value,"
    f" (e.peak_us - e.us) / {float(UNIT)} AS time_to_peak_min, e.peak - e.b AS amplitude, a.iauc,"
    f" (a.back_us - e.peak_us) / {float(UNIT)} AS recovery_time_min,"
    " CASE WHEN e.av > 0 THEN e.sd / e.av * 100 END AS cv_postprandial, e.g2h AS glucose_2h,"
    " e.n AS n_readings_post FROM base e JOIN area a USING (meal_id) JOIN meals m USING (meal_id)",
}
RESP = ctes("readings", "meals", extra=PARTS)


def resp_sql(*cols: str, plain: tuple[str, ...] = ("meal_id",)) -> str:
    return RESP + "SELECT " + ", ".join([*plain, *[f"{r(c)} AS {c}" for c in cols]]) + " FROM resp"


def responses(spark, sf_dir) -> DataFrame:
    meals, readings = both(spark, sf_dir)
    return R.response(meals, readings, SCALE)


ALL = (
    "glucose_preprandial", "glucose_preprandial_mean", "peak_value", "time_to_peak_min", "amplitude", "iauc",
    "recovery_time_min", "cv_postprandial", "glucose_2h",
)


@query("a14_response_bundle", resp_sql(*ALL, plain=("meal_id", "user_id", "n_readings_post")))
def bundle(spark, sf_dir):
    return r6(responses(spark, sf_dir), *ALL).select("meal_id", "user_id", "n_readings_post", *ALL)


def _one(name: str, *cols: str):
    @query(name, resp_sql(*cols))
    def run(spark, sf_dir):
        return r6(responses(spark, sf_dir), *cols).select("meal_id", *cols)

    return run


_one("a08_window_mean", "glucose_preprandial_mean")
_one("a09_peak", "peak_value", "time_to_peak_min", "amplitude")
_one("a10_iauc", "iauc")
_one("a11_recovery", "recovery_time_min")
_one("a12_cv", "cv_postprandial")
_one("a13_two_hour_mean", "glucose_2h")


@query(
    "j06_interval_join",
    ctes("readings", "meals")
    + "SELECT m.meal_id, g.r_id, (g.r_us > m.us) AS is_post, "
    + r(f"(g.r_us - m.us) / {float(UNIT)}")
    + f" AS minutes FROM meals m JOIN readings g ON g.user_id = m.user_id AND g.r_us BETWEEN m.us - {15 * UNIT}"
    f" AND m.us + {180 * UNIT}",
)
def pairs(spark, sf_dir):
    meals, readings = both(spark, sf_dir)
    joined = interval_join(
        meals.select("meal_id", "user_id", "us"), readings.select("user_id", "r_us", "r_id"), ["user_id"],
        -15 * UNIT, 180 * UNIT,
    )
    d = F.col("r_us") - F.col("us")
    return r6(
        joined.select("meal_id", "r_id", (d > 0).alias("is_post"), (d / F.lit(float(UNIT))).alias("minutes")), "minutes"
    )


@query(
    "j06_plain_counts",
    ctes("readings", "meals")
    + "SELECT m.meal_id, count(*) AS n FROM meals m JOIN readings g ON g.user_id = m.user_id AND"
    f" g.r_us > m.us AND g.r_us <= m.us + {180 * UNIT} GROUP BY m.meal_id",
)
def plain_counts(spark, sf_dir):
    meals, readings = both(spark, sf_dir)
    joined = plain_interval_join(
        meals.select("meal_id", "user_id", "us"), readings.select("user_id", "r_us"), ["user_id"], 0, 180 * UNIT,
        "right",
    )
    return joined.groupBy("meal_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j07_as_of",
    ctes("readings", "meals")
    + "SELECT m.meal_id, arg_max(g.r_value, g.r_us) AS last_value FROM meals m LEFT JOIN readings g"
    f" ON g.user_id = m.user_id AND g.r_us BETWEEN m.us - {15 * UNIT} AND m.us GROUP BY m.meal_id",
)
def asof(spark, sf_dir):
    meals, readings = both(spark, sf_dir)
    return as_of(meals, readings, "meal_id", ["user_id"], 15 * UNIT, "r_value", "last_value", "r_id").select(
        "meal_id", "last_value"
    )


PRE_SQL = {
    "w": "SELECT m.meal_id, g.r_us, g.r_value AS v, m.us - g.r_us AS d,"
    f" (g.r_us - m.us) / {float(UNIT)} AS x FROM meals m JOIN readings g ON g.user_id = m.user_id"
    f" AND g.r_us BETWEEN m.us - {90 * UNIT} AND m.us",
    **{
        f"w{k}": f"SELECT meal_id, count(*) AS n, regr_slope(v, x) AS slope, arg_max(v, r_us) - arg_min(v, r_us) AS delta,"
        f" stddev_pop(v) AS sd, avg(CASE WHEN v BETWEEN 70 AND 140 THEN 100.0 ELSE 0 END) AS tir,"
        f" avg(CASE WHEN v > 140 THEN 100.0 ELSE 0 END) AS above FROM w WHERE d <= {k * UNIT} GROUP BY meal_id"
        for k in (30, 60, 90)
    },
    "prew": "SELECT m.*, CASE WHEN a.n >= 2 THEN a.slope END AS cgm_slope_30m,"
    " CASE WHEN b.n >= 2 THEN b.slope END AS cgm_slope_60m, CASE WHEN a.n >= 2 THEN a.sd END AS cgm_std_30m,"
    " CASE WHEN a.n >= 2 THEN a.delta END AS cgm_delta_30m, CASE WHEN b.n >= 2 THEN b.delta END AS cgm_delta_60m,"
    " CASE WHEN b.n >= 2 THEN b.tir END AS cgm_tir_pre, CASE WHEN b.n >= 2 THEN b.above END AS cgm_pct_above_target,"
    " coalesce(b.n, 0) AS n_readings_pre_60m, CASE WHEN c.n >= 3 THEN c.slope END AS cgm_slope_90m,"
    " CASE WHEN c.n >= 3 THEN c.delta END AS cgm_delta_90m, CASE WHEN c.n >= 3 THEN c.sd END AS cgm_std_90m,"
    " coalesce(CASE WHEN b.n >= 2 THEN b.slope END, CASE WHEN c.n >= 3 THEN c.slope END) AS cgm_slope_best,"
    " coalesce(CASE WHEN b.n >= 2 THEN b.delta END, CASE WHEN c.n >= 3 THEN c.delta END) AS cgm_delta_best,"
    " CASE WHEN b.n >= 2 THEN 60 WHEN c.n >= 3 THEN 90 END AS cgm_window_used FROM meals m"
    " LEFT JOIN w30 a USING (meal_id) LEFT JOIN w60 b USING (meal_id) LEFT JOIN w90 c USING (meal_id)",
}
PRE = ctes("readings", "meals", extra=PRE_SQL)


def pre_sql(*cols: str, plain: tuple[str, ...] = ("meal_id",)) -> str:
    return PRE + "SELECT " + ", ".join([*plain, *[f"{r(c)} AS {c}" for c in cols]]) + " FROM prew"


def _pre(name: str, *cols: str, plain: tuple[str, ...] = ()):
    @query(name, pre_sql(*cols, plain=("meal_id", *plain)))
    def run(spark, sf_dir):
        meals, readings = both(spark, sf_dir)
        return r6(R.pre_window(meals, readings, SCALE), *cols).select("meal_id", *plain, *cols)

    return run


_pre("j08_pre_windows", "cgm_slope_30m", "cgm_slope_60m", "cgm_std_30m", "cgm_delta_30m", "cgm_delta_60m",
     "cgm_tir_pre", "cgm_pct_above_target", plain=("n_readings_pre_60m",))
_pre("j09_pre_90", "cgm_slope_90m", "cgm_delta_90m", "cgm_std_90m")
_pre("a15_slope", "cgm_slope_30m", "cgm_slope_60m")
_pre("a16_delta", "cgm_delta_30m", "cgm_delta_60m")
_pre("a17_window_std", "cgm_std_30m", "cgm_std_90m")
_pre("a18_time_in_range", "cgm_tir_pre", "cgm_pct_above_target")
_pre("e11_fallback_window", "cgm_slope_best", "cgm_delta_best", plain=("cgm_window_used",))


@query(
    "j16_skipped",
    ctes("readings", "meals")
    + ", n AS (SELECT m.meal_id, count(g.r_us) AS n FROM meals m LEFT JOIN readings g ON g.user_id = m.user_id"
    f" AND g.r_us > m.us AND g.r_us <= m.us + {180 * UNIT} GROUP BY m.meal_id)"
    " SELECT count(*) AS n_events, count(*) FILTER (WHERE user_id NOT IN (SELECT user_id FROM readings)) AS no_series,"
    " count(*) FILTER (WHERE n < 5 AND user_id IN (SELECT user_id FROM readings)) AS too_few,"
    " count(*) FILTER (WHERE n >= 5) AS processed FROM meals JOIN n USING (meal_id)",
)
def skips(spark, sf_dir):
    meals, readings = both(spark, sf_dir)
    return R.skipped(meals, readings, SCALE)


@query(
    "j16_unmatched_list",
    ctes("readings", "meals")
    + "SELECT m.meal_id, m.user_id FROM meals m WHERE NOT EXISTS (SELECT 1 FROM readings g WHERE g.user_id = m.user_id"
    f" AND g.r_us > m.us AND g.r_us <= m.us + {12 * UNIT})",
)
def unmatched(spark, sf_dir):
    meals, readings = both(spark, sf_dir)
    found = interval_agg(
        meals, readings.select("user_id", "r_us"), "meal_id", ["user_id"], 0, 12 * UNIT,
        [F.count(F.lit(1)).alias("n")], closed="right",
    )
    return meals.join(found, "meal_id", "left_anti").select("meal_id", "user_id")


@query(
    "p18_event_slice",
    ctes("readings", "meals")
    + "SELECT m.meal_id, g.r_id, g.r_value, (g.r_us - m.us > 0) AS is_post, "
    + r(f"(g.r_us - m.us) / {float(UNIT)}")
    + " AS min_from_meal FROM meals m JOIN readings g ON g.user_id = m.user_id AND g.r_us BETWEEN"
    f" m.us - {90 * UNIT} AND m.us + {240 * UNIT}",
)
def event_slice(spark, sf_dir):
    meals, readings = both(spark, sf_dir)
    d = F.col("r_us") - F.col("us")
    joined = interval_join(
        meals.select("meal_id", "user_id", "us"), readings, ["user_id"], -90 * UNIT, 240 * UNIT
    )
    return r6(
        joined.select(
            "meal_id", "r_id", "r_value", (d > 0).alias("is_post"), (d / F.lit(float(UNIT))).alias("min_from_meal")
        ),
        "min_from_meal",
    )


@query(
    "w01_previous_reading",
    ctes("readings")
    + ", s AS (SELECT *, lag(r_us) OVER w AS p_us, lag(r_value) OVER w AS p_v FROM readings"
    " WINDOW w AS (PARTITION BY user_id ORDER BY r_us, r_id))"
    f" SELECT r_id, CASE WHEN r_us - p_us <= {48 * UNIT} THEN p_v END AS prev_value, "
    + r(f"CASE WHEN r_us - p_us <= {48 * UNIT} THEN (r_us - p_us) / {float(UNIT)} END")
    + " AS gap FROM s",
)
def previous(spark, sf_dir):
    s = previous_in_series(roles.readings(spark, sf_dir), ["user_id"], 48 * UNIT, "r_us", ["r_value"], ["r_id"])
    return r6(
        s.select(
            "r_id", F.col("prev_r_value").alias("prev_value"),
            ((F.col("r_us") - F.col("prev_r_us")) / F.lit(float(UNIT))).alias("gap"),
        ),
        "gap",
    )
