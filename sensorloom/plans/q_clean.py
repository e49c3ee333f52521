"""Cleaning rules, flags and the audit log."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.operators import clean as L
from sensorloom.operators.metrics import with_errors
from sensorloom.operators.ranks import hash_sample
from sensorloom.plans.q_context import ROLL
from sensorloom.plans.q_response import RESP, r6, responses
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import K, ctes, r
from sensorloom.sources import roles

TIMES = (
    "SELECT event_id AS id, date_trunc('second', ts) AS ts, value AS value_decimal,"
    f" CASE WHEN {K} % 9 NOT IN (3, 4) THEN date_trunc('second', ts) END AS t FROM events"
)
SPORT = (
    "SELECT event_id AS id, user_id, ts, ["
    + ", ".join(f"'{w}'" for w in roles.ACTIVITY_WORDS)
    + f"][{K} % {len(roles.ACTIVITY_WORDS)} + 1] AS type, CASE WHEN {K} % 3 = 0 THEN 0.0 ELSE value * 2 END AS duration"
    " FROM events WHERE event_type = 'error'"
)
MORNING = (
    "SELECT c_custkey AS user_id, CAST(c_nationkey AS DOUBLE) * 10 AS resting_hr, c_acctbal / 20 AS glucose_basal,"
    " c_acctbal / 10 AS sleep_time, c_acctbal / 25 AS hr_variability FROM customer"
)


def pairs_sql(table: dict[str, list[str]]) -> str:
    return ", ".join(f"('{a}', '{n}')" for n, aliases in table.items() for a in aliases)


@query("p01_parse_times", f"WITH t AS ({TIMES}) SELECT id, t AS ts, value_decimal FROM t")
def parse(spark, sf_dir):
    out = L.parse_times(roles.raw_times(spark, sf_dir))
    return out.select("id", F.col("timestamp").cast("timestamp_ntz").alias("ts"), "value_decimal")


@query(
    "p02_rename",
    "SELECT event_id AS user_id, value FROM events",
)
def rename(spark, sf_dir):
    return roles.table(spark, sf_dir, "events").select("event_id", "value").withColumnRenamed("event_id", "user_id")


@query("p03_keep_range", "SELECT event_id, user_id, value FROM events WHERE value BETWEEN 40 AND 400")
def keep_range(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return L.keep_range(e, "value", fixed.VALUE_LO, fixed.VALUE_HI)


@query("p04_keep_since", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-01-01'")
def keep_since(spark, sf_dir):
    return L.keep_since(roles.table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01").select(
        "o_orderkey", "o_orderdate"
    )


@query(
    "p05_negative_to_null",
    ctes("raw_items") + "SELECT meal_id, food_id, id, CASE WHEN carbs >= 0 THEN carbs END AS carbs FROM raw_items",
)
def negative(spark, sf_dir):
    out = roles.raw_items(spark, sf_dir).withColumn("carbs", C.null_if("carbs", F.col("carbs") < 0))
    return out.select("meal_id", "food_id", "id", "carbs")


ITEM_COLS = ("amount", "calories", "protein", "fat", "carbs")


@query(
    "p06_above_to_null",
    ctes("items") + "SELECT meal_id, food_id, id, " + ", ".join(f"{r(c)} AS {c}" for c in ITEM_COLS) + " FROM items",
)
def above(spark, sf_dir):
    return r6(roles.items(spark, sf_dir), *ITEM_COLS).select("meal_id", "food_id", "id", *ITEM_COLS)


@query(
    "p07_sentinel_to_null",
    f"WITH s AS ({SPORT}) SELECT id, CASE WHEN duration <> 0 AND duration <= 300 THEN duration END AS duration FROM s",
)
def sentinel(spark, sf_dir):
    return L.clean_activity(roles.raw_sport(spark, sf_dir)).select("id", "duration")


@query(
    "p08_two_sided",
    f"WITH m AS ({MORNING}) SELECT user_id,"
    " CASE WHEN resting_hr < 0 OR (resting_hr >= 30 AND resting_hr <= 120) THEN resting_hr END AS resting_hr,"
    " CASE WHEN glucose_basal < 0 OR (glucose_basal >= 40 AND glucose_basal <= 300) THEN glucose_basal END AS glucose_basal,"
    " CASE WHEN sleep_time <= 840 THEN sleep_time END AS sleep_time,"
    " CASE WHEN hr_variability <= 300 THEN hr_variability END AS hr_variability FROM m",
)
def two_sided(spark, sf_dir):
    return L.clean_morning(roles.raw_morning(spark, sf_dir))


def flagged(spark, sf_dir):
    return L.flag_exists(roles.order_meals(spark, sf_dir), roles.raw_items(spark, sf_dir), "id", "meal_id")


FLAGGED = (
    "SELECT o_orderkey AS id, o_custkey AS user_id, o_orderpriority AS type,"
    " o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_items FROM orders"
)


@query("p09_has_items", f"SELECT id, user_id, has_items FROM ({FLAGGED})")
def has_items(spark, sf_dir):
    return flagged(spark, sf_dir).select("id", "user_id", "has_items")


@query(
    "p10_activity_names",
    f"WITH s AS ({SPORT}), m(a, n) AS (VALUES {pairs_sql(fixed.ACTIVITY_ALIASES)})"
    " SELECT id, type AS type_original, coalesce(n, type) AS type_normalized FROM s LEFT JOIN m ON a = type",
)
def names(spark, sf_dir):
    return L.clean_activity(roles.raw_sport(spark, sf_dir)).select("id", "type_original", "type_normalized")


@query(
    "p11_intensity",
    f"WITH s AS ({SPORT}), m(a, n) AS (VALUES {pairs_sql(fixed.ACTIVITY_ALIASES)}),"
    f" i(n, level) AS (VALUES {', '.join(f'({chr(39)}{n}{chr(39)}, {chr(39)}{lv}{chr(39)})' for lv, ns in fixed.ACTIVITY_INTENSITY.items() for n in ns)})"
    " SELECT id, coalesce(level, 'moderate') AS intensity_category FROM s LEFT JOIN m ON a = type"
    " LEFT JOIN i ON i.n = coalesce(m.n, type)",
)
def intensity(spark, sf_dir):
    return L.clean_activity(roles.raw_sport(spark, sf_dir)).select("id", "intensity_category")


LIMITS = {"readings": 40, "meals": 12, "sport": 12, "questionnaire": 12}
COUNTS = (
    "SELECT user_id, count(*) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS n_glucose_readings,"
    " count(*) FILTER (WHERE event_type = 'purchase') AS n_meals,"
    " count(*) FILTER (WHERE event_type = 'error') AS n_sport_sessions,"
    " count(*) FILTER (WHERE event_type = 'signup') AS n_quest_morning,"
    " count(*) FILTER (WHERE event_type = 'click') AS n_quest_night FROM events GROUP BY user_id"
    " HAVING count(*) FILTER (WHERE event_type IN ('view', 'click', 'signup')) > 0"
)


def quality(spark, sf_dir):
    return L.user_quality(
        roles.readings(spark, sf_dir),
        roles.meals(spark, sf_dir).withColumn("has_items", F.lit(True)),
        roles.sport(spark, sf_dir),
        roles.answers(spark, sf_dir),
        roles.events(spark, sf_dir, "click"),
        LIMITS,
    )


@query(
    "p12_quality_flags",
    f"WITH c AS ({COUNTS}), f AS (SELECT *, n_glucose_readings >= 40 AS has_glucose, n_meals >= 12 AS has_meals,"
    " n_sport_sessions >= 12 AS has_sport, greatest(n_quest_morning, n_quest_night) >= 12 AS has_questionnaires FROM c)"
    " SELECT user_id, has_glucose, has_meals, has_sport, has_questionnaires, CAST(CAST(has_glucose AS INT) +"
    " CAST(has_meals AS INT) + CAST(has_sport AS INT) + CAST(has_questionnaires AS INT) AS INTEGER) AS completeness_score,"
    " has_glucose AND has_meals AS viable_glycemic_model FROM f",
)
def quality_flags(spark, sf_dir):
    return quality(spark, sf_dir).select(
        "user_id", "has_glucose", "has_meals", "has_sport", "has_questionnaires", "completeness_score",
        "viable_glycemic_model",
    )


@query("j05_user_counts", COUNTS)
def user_counts(spark, sf_dir):
    return quality(spark, sf_dir).select(
        "user_id", "n_glucose_readings", "n_meals", "n_sport_sessions", "n_quest_morning", "n_quest_night"
    )


@query("a03_rows_per_user", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def rows_per_user(spark, sf_dir):
    return roles.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("p13_boolean_filter", f"SELECT id, user_id, type FROM ({FLAGGED}) WHERE has_items")
def boolean_filter(spark, sf_dir):
    return flagged(spark, sf_dir).where("has_items").select("id", "user_id", "type")


@query(
    "p14_project",
    RESP + "SELECT meal_id, user_id, " + ", ".join(f"{r(c)} AS {c}" for c in ("peak_value", "iauc", "carbs")) + " FROM resp",
)
def project(spark, sf_dir):
    df = responses(spark, sf_dir)
    front = C.existing(df.columns, ["meal_id", "user_id", "meal_timestamp", "peak_value", "iauc"])
    rest = C.existing(df.columns, ["carbs", "not_there"])
    return r6(df.select(*front, *rest), "peak_value", "iauc", "carbs")


@query(
    "p15_drop_null_rows",
    ctes("foods") + "SELECT food_id, food_esp_name, fibre_gram_value FROM foods WHERE fibre_gram_value IS NOT NULL",
)
def drop_null(spark, sf_dir):
    foods = roles.foods(spark, sf_dir).select("food_id", "food_esp_name", "fibre_gram_value")
    return foods.na.drop(subset=["food_esp_name", "fibre_gram_value"])


@query(
    "p16_target_validity",
    RESP
    + "SELECT meal_id, peak_value > 0 AS valid_peak, time_to_peak_min > 0 AND time_to_peak_min <= 180 AS valid_time,"
    " iauc IS NOT NULL AS valid_area, time_to_peak_min < 45 OR time_to_peak_min > 75 AS extreme FROM resp"
    " WHERE peak_value IS NOT NULL",
)
def target_validity(spark, sf_dir):
    t = F.col("time_to_peak_min")
    return responses(spark, sf_dir).where(F.col("peak_value").isNotNull()).select(
        "meal_id", (F.col("peak_value") > 0).alias("valid_peak"), ((t > 0) & (t <= 180)).alias("valid_time"),
        C.log_floor("iauc").isNotNull().alias("valid_area"), C.is_extreme_time(t).alias("extreme"),
    )


@query(
    "p17_bound_number",
    ctes("foods") + "SELECT food_id, least(greatest(coalesce(TRY_CAST(portion AS DOUBLE), 100.0), 5.0), 500.0) AS portion,"
    " CASE WHEN atri_high_glycemic_index = 'Si' THEN 1.0::DOUBLE ELSE 0.0 END AS high_gi FROM foods",
)
def bound(spark, sf_dir):
    return roles.foods(spark, sf_dir).select(
        "food_id", C.bound_number("portion", 100.0, 5.0, 500.0).alias("portion"),
        C.is_flag("atri_high_glycemic_index").cast("double").alias("high_gi"),
    )


@query(
    "p19_seeded_sample",
    "SELECT event_id, user_id, value FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 2000",
)
def sample(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return hash_sample(e, ["event_id"], 2000, 42)


def audit_sql(source: str, table: str, rules: list[tuple[str, str, str, bool]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{a}' AS action, count(*) FILTER (WHERE {h}) AS n_affected, count(*) AS n_total,"
        f" '{why}' AS justification, {str(always).lower()} AS keep FROM src"
        for a, h, why, always in rules
    )
    return (
        f"WITH src AS ({source}), a AS ({rows}) SELECT \"table\", action, n_affected, n_total,"
        " (round(n_affected / n_total * 100, 3) + 0.0) AS pct_affected, justification FROM a WHERE keep OR n_affected > 0"
    )


@query(
    "a01_audit_items",
    audit_sql(
        ctes("raw_items") + "SELECT * FROM raw_items", "meal_item",
        [(L.said(c, "< 0", L.DROP_VALUE), f"{c} < 0", L.REASONS["sign"], False) for c in fixed.ITEM_NON_NEGATIVE]
        + [(L.said(c, f"> {t:g}", L.DROP_VALUE), f"{c} > {t}", L.REASONS["range"], False) for c, t in fixed.ITEM_LIMITS.items()],
    ),
)
def audit_items(spark, sf_dir):
    return L.audit(roles.raw_items(spark, sf_dir), "meal_item", L.item_rules())


@query(
    "a01_audit_times",
    audit_sql(
        TIMES, "glucose",
        [("time read: noted", "t IS NOT NULL", L.REASONS["time"], True),
         ("time not read: value becomes null", "t IS NULL", L.REASONS["time"], False)],
    ),
)
def audit_times(spark, sf_dir):
    return L.audit(roles.raw_times(spark, sf_dir), "glucose", L.parse_rules())


@query(
    "a01_audit_readings",
    audit_sql(
        TIMES, "glucose",
        [("reading < 40: row goes", "value_decimal < 40", L.REASONS["range"], True),
         ("reading > 400: row goes", "value_decimal > 400", L.REASONS["range"], True),
         ("time too early or missing: row goes", "value_decimal BETWEEN 40 AND 400 AND (t IS NULL OR t < DATE '2020-01-01')",
          L.REASONS["day"], False)],
    ),
)
def audit_readings(spark, sf_dir):
    raw = L.parse_times(roles.raw_times(spark, sf_dir))
    return L.audit(raw, "glucose", L.reading_rules(raw))


@query(
    "a01_audit_activity",
    audit_sql(
        SPORT, "sport",
        [("duration = 0: value becomes null", "duration = 0", L.REASONS["zero"], True),
         ("duration > 300: value becomes null", "duration > 300", L.REASONS["range"], True),
         ("type given its common name: noted", "type IS NOT NULL", L.REASONS["name"], True)],
    ),
)
def audit_activity(spark, sf_dir):
    raw = roles.raw_sport(spark, sf_dir)
    return L.audit(raw, "sport", L.activity_rules(raw))


@query(
    "a01_audit_morning",
    audit_sql(
        MORNING, "quest_morning",
        [("resting_hr = 0: value becomes null", "resting_hr = 0", L.REASONS["zero"], True),
         ("resting_hr not in 30 to 120: value becomes null", "resting_hr > 120 OR (resting_hr > 0 AND resting_hr < 30)", L.REASONS["range"], True),
         ("glucose_basal = 0: value becomes null", "glucose_basal = 0", L.REASONS["zero"], True),
         ("glucose_basal not in 40 to 300: value becomes null", "glucose_basal > 300 OR (glucose_basal > 0 AND glucose_basal < 40)", L.REASONS["range"], True),
         ("sleep_time > 840: value becomes null", "sleep_time > 840", L.REASONS["range"], True),
         ("hr_variability > 300: value becomes null", "hr_variability > 300", L.REASONS["range"], True)],
    ),
)
def audit_morning(spark, sf_dir):
    return L.audit(roles.raw_morning(spark, sf_dir), "quest_morning", L.morning_rules())


@query(
    "a01_audit_meals",
    audit_sql(FLAGGED, "meal", [("meal without items: noted", "NOT has_items", L.REASONS["item"], True)]),
)
def audit_meals(spark, sf_dir):
    return L.audit(flagged(spark, sf_dir), "meal", L.flag_rules())


@query(
    "a02_before_after",
    f"WITH t AS ({TIMES}), s AS ({SPORT})"
    " SELECT 'glucose' AS \"table\", count(*) AS n_before, count(*) FILTER (WHERE value_decimal BETWEEN 40 AND 400 AND"
    " t >= DATE '2020-01-01') AS n_after, count(*) FILTER (WHERE value_decimal BETWEEN 40 AND 400 AND"
    " t >= DATE '2020-01-01') - count(*) AS delta FROM t"
    " UNION ALL SELECT 'sport', count(*), count(*), 0 FROM s UNION ALL SELECT 'meal_item', count(*), count(*), 0 FROM lineitem",
)
def before_after(spark, sf_dir):
    raw = L.parse_times(roles.raw_times(spark, sf_dir))
    sport, items = roles.raw_sport(spark, sf_dir), roles.raw_items(spark, sf_dir)
    return L.before_after(
        {
            "glucose": (raw, L.clean_readings(raw)),
            "sport": (sport, L.clean_activity(sport)),
            "meal_item": (items, L.clean_items(items)),
        }
    )


@query("u01_distinct_keys", "SELECT DISTINCT l_orderkey AS meal_id FROM lineitem")
def distinct_keys(spark, sf_dir):
    return roles.raw_items(spark, sf_dir).select("meal_id").distinct()


@query("e15_rounding", "SELECT p_partkey, (round_even(p_retailprice / 8, 1) + 0.0) AS price FROM part")
def rounding(spark, sf_dir):
    return roles.table(spark, sf_dir, "part").select(
        "p_partkey", (F.bround(F.col("p_retailprice") / 8, 1) + F.lit(0.0)).alias("price")
    )


@query(
    "e14_errors",
    ROLL + "SELECT meal_id, " + r("user_peak_mean_roll - peak_value") + " AS error, "
    + r("abs(user_peak_mean_roll - peak_value)") + " AS abs_error, (user_peak_mean_roll > 160) = (peak_value > 160) AS correct"
    " FROM roll WHERE user_peak_mean_roll IS NOT NULL",
)
def errors(spark, sf_dir):
    from sensorloom.plans.q_metrics import predictions

    out = with_errors(predictions(spark, sf_dir), "peak_value", "prediction")
    return r6(out, "error", "abs_error").select(
        "meal_id", "error", "abs_error", ((F.col("prediction") > 160) == (F.col("peak_value") > 160)).alias("correct")
    )
