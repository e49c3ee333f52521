"""Activity, questionnaires, rolling and same-day state, user statistics, calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import columns as C
from sensorloom.operators import context as X
from sensorloom.operators.ranks import label_codes
from sensorloom.operators.temporal import first_row
from sensorloom.plans.q_response import PARTS, both, r6, responses
from sensorloom.plans.registry import query
from sensorloom.session import durable
from sensorloom.plans.sql_text import HOUR, ctes, r
from sensorloom.sources import roles

SCALE = roles.SCALE
DAY = 86_400_000_000
ACT = 60 * HOUR  # one hour of the activity windows at this scale

ACT_PARTS = {
    "aw": "SELECT m.meal_id, m.us, s.r_us, s.duration, s.intensity_category AS lv, m.us - s.r_us AS d,"
    " CASE s.intensity_category WHEN 'low' THEN 1.0 WHEN 'moderate' THEN 2.0 WHEN 'high' THEN 3.0 ELSE 0 END AS sc"
    f" FROM meals m JOIN sport s ON s.user_id = m.user_id AND s.r_us >= m.us - {48 * ACT} AND s.r_us < m.us",
    "aa": f"SELECT meal_id, sum(duration) FILTER (WHERE d <= {24 * ACT}) AS d24,"
    f" count(*) FILTER (WHERE d <= {24 * ACT}) AS n24,"
    f" max(CASE WHEN d <= {24 * ACT} THEN CASE lv WHEN 'high' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END END) AS top,"
    f" max(r_us) FILTER (WHERE d <= {24 * ACT}) AS last_us, sum(duration) FILTER (WHERE d <= {2 * ACT}) AS d2,"
    f" sum(duration) FILTER (WHERE d <= {6 * ACT}) AS d6, sum(duration) AS d48, count(*) AS n48,"
    " CASE WHEN sum(coalesce(duration, 0)) > 0 THEN sum(sc * coalesce(duration, 0)) / sum(coalesce(duration, 0))"
    " ELSE avg(sc) END AS score FROM aw GROUP BY meal_id",
    "act": "SELECT m.meal_id, m.user_id, coalesce(d24, 0) AS sport_prior_duration, coalesce(n24, 0) AS sport_prior_sessions,"
    " CASE top WHEN 3 THEN 'high' WHEN 2 THEN 'moderate' WHEN 1 THEN 'low' ELSE 'none' END AS sport_prior_intensity,"
    f" (m.us - last_us) / {float(ACT)} AS hours_since_last_sport, coalesce(d2, 0) AS sport_2h_duration,"
    " coalesce(d6, 0) AS sport_6h_duration, coalesce(d48, 0) AS sport_48h_duration,"
    " coalesce(n48, 0) AS sport_48h_sessions, coalesce(score, 0) AS sport_intensity_score"
    " FROM meals m LEFT JOIN aa USING (meal_id)",
}
ACT_SQL = ctes("meals", "sport", extra=ACT_PARTS)


def _act(name, *cols, plain=()):
    sql = ACT_SQL + "SELECT " + ", ".join(["meal_id", *plain, *[f"{r(c)} AS {c}" for c in cols]]) + " FROM act"

    @query(name, sql)
    def run(spark, sf_dir):
        acted = X.prior_activity(roles.meals(spark, sf_dir), roles.sport(spark, sf_dir), SCALE)
        return r6(acted, *cols).select("meal_id", *plain, *cols)


_act("j10_prior_activity", "sport_prior_duration", plain=("sport_prior_sessions",))
_act("j11_activity_windows", "sport_2h_duration", "sport_6h_duration", "sport_48h_duration", plain=("sport_48h_sessions",))
_act("a20_activity_bundle", "sport_prior_duration", "hours_since_last_sport",
     plain=("sport_prior_sessions", "sport_prior_intensity"))
_act("a21_intensity_score", "sport_intensity_score")

def _daily_sql(lag: int, names: dict[str, str], flag: str) -> str:
    return (
        ctes("meals", "answers")
        + ", f AS (SELECT *, CAST(ts AS DATE) AS d, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)"
        " ORDER BY ts, id) AS rn FROM answers) SELECT m.meal_id, "
        + ", ".join(f"f.{c} AS {n}" for c, n in names.items())
        + f", coalesce(f.flag, false) AS {flag} FROM meals m LEFT JOIN f ON f.rn = 1 AND f.user_id = m.user_id"
        f" AND f.d = CAST(m.ts AS DATE) - {lag}"
    )


SLEEP = {"score": "sleep_time_prev", "level": "sleep_quality_prev"}
EVENING = {"score": "training_effort_prev", "level": "anxiety_prev"}


@query("j12_same_date", _daily_sql(0, SLEEP, "is_sick"))
def sleep(spark, sf_dir):
    out = X.daily_answers(roles.meals(spark, sf_dir), roles.answers(spark, sf_dir), SLEEP, ("flag", "is_sick"))
    return out.select("meal_id", *SLEEP.values(), "is_sick")


@query("j13_previous_date", _daily_sql(1, EVENING, "out_of_routine_prev"))
def evening(spark, sf_dir):
    out = X.daily_answers(
        roles.meals(spark, sf_dir), roles.answers(spark, sf_dir), EVENING, ("flag", "out_of_routine_prev"), 1
    )
    return out.select("meal_id", *EVENING.values(), "out_of_routine_prev")


@query(
    "w03_first_answer",
    ctes("answers")
    + "SELECT user_id, CAST(ts AS DATE) AS day, (list(id ORDER BY ts, id))[1] AS id,"
    " (list(score ORDER BY ts, id))[1] AS score FROM answers GROUP BY user_id, CAST(ts AS DATE)",
)
def first_answer(spark, sf_dir):
    dated = roles.answers(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return first_row(dated, ["user_id", "day"], ["ts", "id"]).select("user_id", "day", "id", "score")


@query(
    "a19_user_stats",
    ctes("readings")
    + "SELECT user_id, "
    + ", ".join(
        f"{r(e)} AS {n}"
        for n, e in {
            "user_glucose_mean": "avg(r_value)", "user_glucose_std": "stddev_samp(r_value)",
            "user_glucose_median": "median(r_value)", "user_glucose_q25": "quantile_cont(r_value, 0.25)",
            "user_glucose_q75": "quantile_cont(r_value, 0.75)",
            "user_time_in_range": "avg(CASE WHEN r_value BETWEEN 70 AND 140 THEN 100.0 ELSE 0 END)",
        }.items()
    )
    + " FROM readings GROUP BY user_id",
)
def stats(spark, sf_dir):
    s = X.user_stats(roles.readings(spark, sf_dir))
    return r6(s, *[c for c in s.columns if c != "user_id"])


ROLL_PARTS = {
    "rm": "SELECT a.meal_id, count(*) AS n, avg(b.peak_value) AS pm, stddev_samp(b.peak_value) AS ps,"
    " avg(b.time_to_peak_min) AS tm FROM resp a JOIN resp b ON a.user_id = b.user_id"
    f" AND b.us >= a.us - {30 * DAY} AND b.us < a.us GROUP BY a.meal_id",
    "rg": "SELECT a.meal_id, count(*) AS n, avg(g.r_value) AS gm, stddev_samp(g.r_value) AS gs FROM resp a"
    f" JOIN readings g ON g.user_id = a.user_id AND g.r_us >= a.us - {14 * DAY} AND g.r_us < a.us GROUP BY a.meal_id",
    "roll": "SELECT resp.*, CASE WHEN rm.n >= 3 THEN pm END AS user_peak_mean_roll,"
    " CASE WHEN rm.n >= 3 THEN ps END AS user_peak_std_roll, CASE WHEN rm.n >= 3 THEN tm END AS user_ttp_mean_roll,"
    " CASE WHEN rg.n >= 10 THEN gm END AS user_glucose_mean_roll, CASE WHEN rg.n >= 10 THEN gs END AS user_glucose_std_roll"
    " FROM resp LEFT JOIN rm USING (meal_id) LEFT JOIN rg USING (meal_id)",
}
ROLL = ctes("readings", "meals", extra={**PARTS, **ROLL_PARTS})


def digits(column: str) -> int:
    """Means over a power of two rows end on a 5 at the seventh digit or so; these keep more."""
    return 9 if column in ("user_peak_mean_roll", "user_glucose_mean_roll") else 6


def _roll(name, roll, *cols):
    sql = ROLL + "SELECT " + ", ".join(["meal_id", *[f"{r(c, digits(c))} AS {c}" for c in cols]]) + " FROM roll"

    @query(name, sql)
    def run(spark, sf_dir):
        _, readings = both(spark, sf_dir)
        return roll(durable(responses(spark, sf_dir)), readings).select(
            "meal_id", *[(F.round(c, digits(c)) + F.lit(0.0)).alias(c) for c in cols]
        )


_roll("w04_rolling_response", lambda events, readings: X.rolling_response(events, SCALE), "user_peak_mean_roll", "user_peak_std_roll", "user_ttp_mean_roll")
_roll("w05_rolling_readings", X.rolling_readings, "user_glucose_mean_roll", "user_glucose_std_roll")


@query(
    "w04_rolling_safe",
    ctes("readings", "meals", extra=PARTS)
    + "SELECT a.meal_id, "
    + ", ".join(
        f"{r(f'CASE WHEN count(b.meal_id) >= 3 THEN {e} END')} AS {n}"
        for n, e in {
            "user_peak_mean_roll": "avg(b.peak_value)", "user_peak_std_roll": "stddev_samp(b.peak_value)",
            "user_ttp_mean_roll": "avg(b.time_to_peak_min)",
        }.items()
    )
    + f" FROM resp a LEFT JOIN resp b ON a.user_id = b.user_id AND b.us >= a.us - {30 * DAY}"
    f" AND b.us + {180 * HOUR} <= a.us GROUP BY a.meal_id",
)
def rolling_safe(spark, sf_dir):
    cols = ("user_peak_mean_roll", "user_peak_std_roll", "user_ttp_mean_roll")
    _, readings = both(spark, sf_dir)
    rolled = X.rolling_user(responses(spark, sf_dir), readings, SCALE, safe=True)
    return r6(rolled, *cols).select("meal_id", *cols)


@query(
    "w06_same_day",
    ctes("readings", "meals", extra=PARTS)
    + "SELECT a.meal_id, count(b.meal_id) AS prev_meals_today, "
    + r("max(b.peak_value)") + " AS prev_peak_today_max, "
    + r("(any_value(a.us) - max(b.us)) / 3600000000.0") + " AS hours_since_last_meal, "
    + r("coalesce(sum(b.carbs), 0)") + " AS carbs_load_today FROM resp a LEFT JOIN resp b ON a.user_id = b.user_id"
    " AND CAST(a.ts AS DATE) = CAST(b.ts AS DATE) AND b.us < a.us GROUP BY a.meal_id",
)
def day_state(spark, sf_dir):
    cols = ("prev_peak_today_max", "hours_since_last_meal", "carbs_load_today")
    out = X.same_day(responses(spark, sf_dir), carbs="carbs")
    return r6(out, *cols).select("meal_id", "prev_meals_today", *cols)


@query(
    "e04_calendar",
    "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,"
    " CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, CAST(ts AS DATE) AS day FROM events",
)
def calendar(spark, sf_dir):
    e = X.with_calendar(roles.table(spark, sf_dir, "events"))
    return e.select("event_id", "hour_of_day", "day_of_week", "is_weekend", F.to_date("ts").alias("day"))


@query(
    "e05_day_period",
    "SELECT event_id, CASE WHEN hour(ts) BETWEEN 5 AND 9 THEN 'breakfast' WHEN hour(ts) BETWEEN 10 AND 12 THEN"
    " 'mid_morning' WHEN hour(ts) BETWEEN 13 AND 15 THEN 'lunch' WHEN hour(ts) BETWEEN 16 AND 18 THEN 'snack'"
    " WHEN hour(ts) BETWEEN 19 AND 22 THEN 'dinner' ELSE 'night' END AS meal_period FROM events",
)
def period(spark, sf_dir):
    return X.with_calendar(roles.table(spark, sf_dir, "events")).select("event_id", "meal_period")


@query(
    "e06_elapsed",
    "SELECT event_id, " + r("(epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 60000000.0", 4)
    + " AS minutes, " + r("(epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 3600000000.0")
    + " AS hours FROM events",
)
def elapsed(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").withColumn("us", C.micros("ts"))
    start = e.groupBy("user_id").agg(F.min("us").alias("start"))
    out = e.join(start, "user_id").select(
        "event_id", C.elapsed("us", "start", C.US_PER_MIN).alias("minutes"),
        C.elapsed("us", "start", C.US_PER_HOUR).alias("hours"),
    )
    return r6(out, "hours").withColumn("minutes", F.round("minutes", 4) + F.lit(0.0))


@query(
    "w07_label_codes",
    "SELECT event_id, CAST(dense_rank() OVER (ORDER BY coalesce(nullif(event_type, 'click'), 'unknown')) - 1 AS INTEGER)"
    " AS event_type_enc FROM events",
)
def codes(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("click")))
    return label_codes(e, "event_type", "event_type_enc").select("event_id", "event_type_enc")
