"""User profiles, summaries, medians, folds and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.operators import folds as D
from sensorloom.operators import profiles as P
from sensorloom.operators.ranks import exact_quantiles, scalars, wide_medians
from sensorloom.plans.q_nutrition import NUTRITION, nutrition
from sensorloom.plans.q_response import RESP, both, r6, responses
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import r
from sensorloom.session import durable
from sensorloom.sources import roles

MEANS = {
    "avg_calories": "total_calories", "avg_protein": "total_protein", "avg_fat": "total_fat", "avg_carbs": "total_carbs",
    "avg_fibre": "total_fibre", "avg_pct_carbs": "pct_cal_carbs", "avg_pct_protein": "pct_cal_protein",
    "avg_pct_fat": "pct_cal_fat", "avg_fibre_carb_ratio": "fibre_carb_ratio", "avg_ultraprocessed": "n_ultraprocessed",
    "avg_food_groups": "n_food_groups", "avg_items_per_meal": "n_items",
}
ORDERED = NUTRITION + ", om AS (SELECT n.*, o_custkey AS user_id, o_orderdate AS ts FROM nutrition n JOIN orders ON o_orderkey = meal_id) "


def order_nutrition(spark, sf_dir):
    m = roles.order_meals(spark, sf_dir).select(F.col("id").alias("meal_id"), "user_id", "ts")
    return m.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).join(nutrition(spark, sf_dir), "meal_id")


@query(
    "a22_nutrition_profile",
    ORDERED + "SELECT user_id, count(*) AS n_meals, " + ", ".join(f"{r(f'avg({c})', 8)} AS {n}" for n, c in MEANS.items())
    + " FROM om GROUP BY user_id",
)
def nutrition_profile(spark, sf_dir):
    p = P.nutrition_profile(order_nutrition(spark, sf_dir))
    return p.select("user_id", "n_meals", *[(F.round(c, 8) + F.lit(0.0)).alias(c) for c in MEANS])


@query(
    "a23_daily_intake",
    ORDERED + f"SELECT user_id, CAST(floor((max(epoch_us(ts)) - min(epoch_us(ts))) / 86400000000.0) + 1 AS BIGINT) AS n_days,"
    f" {r('sum(total_calories) / (floor((max(epoch_us(ts)) - min(epoch_us(ts))) / 86400000000.0) + 1)')} AS est_daily_calories,"
    f" {r('sum(total_fibre) / (floor((max(epoch_us(ts)) - min(epoch_us(ts))) / 86400000000.0) + 1)')} AS est_daily_fibre"
    " FROM om GROUP BY user_id",
)
def daily(spark, sf_dir):
    p = P.nutrition_profile(order_nutrition(spark, sf_dir))
    return r6(p, "est_daily_calories", "est_daily_fibre").select("user_id", "n_days", "est_daily_calories", "est_daily_fibre")


RESPONSE = {
    "avg_iauc": "avg(iauc)", "avg_amplitude": "avg(amplitude)", "avg_peak": "avg(peak_value)",
    "avg_time_to_peak": "avg(time_to_peak_min)", "avg_cv_post": "avg(cv_postprandial)",
    "pct_high_spikes": "avg(CASE WHEN peak_value > 160 THEN 100.0 ELSE 0 END)",
    "response_consistency": "stddev_samp(iauc)", "avg_preprandial": "avg(glucose_preprandial)",
}
READ = {
    "time_in_range": "avg(CASE WHEN r_value BETWEEN 70 AND 140 THEN 100.0 ELSE 0 END)", "glucose_mean": "avg(r_value)",
    "glucose_std": "stddev_samp(r_value)",
}


@query(
    "a24_response_profile",
    RESP + ", g AS (SELECT user_id, " + ", ".join(f"{e} AS {n}" for n, e in READ.items()) + " FROM readings GROUP BY user_id),"
    " m AS (SELECT user_id, " + ", ".join(f"{e} AS {n}" for n, e in RESPONSE.items()) + " FROM resp GROUP BY user_id)"
    " SELECT user_id, " + ", ".join(f"{r(n)} AS {n}" for n in [*RESPONSE, *READ]) + " FROM m JOIN g USING (user_id)",
)
def response_profile(spark, sf_dir):
    _, readings = both(spark, sf_dir)
    p = P.response_profile(responses(spark, sf_dir), readings)
    return r6(p, *RESPONSE, *READ).select("user_id", *RESPONSE, *READ)


@query(
    "a25_category_shares",
    "SELECT event_type, count(*) AS n, " + r("count(*) * 100.0 / (SELECT count(*) FROM events)")
    + " AS pct FROM events GROUP BY event_type",
)
def shares(spark, sf_dir):
    return r6(P.category_shares(roles.table(spark, sf_dir, "events"), "event_type", "event_type"), "pct")


@query(
    "w09_share_of_total",
    "SELECT event_type, CAST(ts AS DATE) AS day, " + r("sum(value) / (SELECT sum(value) FROM events) * 100") + " AS pct"
    " FROM events GROUP BY event_type, CAST(ts AS DATE)",
)
def value_shares(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    total = e.agg(F.sum("value").alias("t")).scalar()
    by = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("v"))
    return r6(by.select("event_type", "day", (F.col("v") / total * 100).alias("pct")), "pct")


@query(
    "a25_class_ratio",
    "SELECT count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1, "
    + r("count(*) FILTER (WHERE quality = 0) / count(*) FILTER (WHERE quality = 1)") + " AS ratio FROM labels",
)
def ratio(spark, sf_dir):
    return r6(P.class_ratio(roles.table(spark, sf_dir, "labels"), "quality"), "ratio")


NUMERIC = ("peak_value", "time_to_peak_min", "iauc")


@query(
    "a26_numeric_profile",
    RESP + " UNION ALL ".join(
        f"SELECT '{c}' AS name, count({c}) AS n, {r(f'avg({c})')} AS mean, {r(f'stddev_pop({c})')} AS std_pop,"
        f" {r(f'stddev_samp({c})')} AS std_samp, {r(f'min({c})')} AS lo, {r(f'max({c})')} AS hi FROM resp" for c in NUMERIC
    ),
)
def numeric(spark, sf_dir):
    return r6(P.numeric_profile(responses(spark, sf_dir), NUMERIC), "mean", "std_pop", "std_samp", "lo", "hi")


COVER = ("glucose_preprandial", "recovery_time_min", "glucose_2h", "iauc")


@query(
    "a27_coverage",
    RESP + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'count({c}) * 100.0 / count(*)')} AS pct_not_null FROM resp" for c in COVER
    ),
)
def cover(spark, sf_dir):
    return r6(P.coverage(responses(spark, sf_dir), COVER), "pct_not_null")


MEDIANS = ("glucose_preprandial", "peak_value", "iauc", "recovery_time_min", "carbs")


@query("a28_medians", RESP + "SELECT " + ", ".join(f"{r(f'median({c})')} AS {c}" for c in MEDIANS) + " FROM resp")
def medians(spark, sf_dir):
    return r6(wide_medians(responses(spark, sf_dir), MEDIANS), *MEDIANS)


@query(
    "a19_exact_quantiles",
    " UNION ALL ".join(
        f"SELECT event_type, CAST({q} AS DOUBLE) AS q, count(*) AS n, {r(f'quantile_cont(value, {q})')} AS value"
        " FROM events GROUP BY event_type"
        for q in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
)
def quantiles(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    q = exact_quantiles(e, ["value"], [0.05, 0.25, 0.5, 0.75, 0.95], ["event_type"])
    return r6(q, "value").select("event_type", "q", "n", "value")


@query(
    "a36_histogram",
    "WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM events), b AS (SELECT CAST(least(floor((value"
    " - lo) / w), 49) AS INTEGER) AS bin FROM events, e) SELECT bin, " + r("any_value(lo) + bin * any_value(w)")
    + " AS left_edge, count(*) AS n FROM b, e GROUP BY bin",
)
def histogram(spark, sf_dir):
    return r6(P.histogram(roles.table(spark, sf_dir, "events"), "value", 50), "left_edge")


@query(
    "a36_histogram_clipped",
    RESP + ", v AS (SELECT least(greatest(time_to_peak_min, 0), 150) AS v FROM resp), e AS (SELECT min(v) AS lo,"
    " (max(v) - min(v)) / 60 AS w FROM v), b AS (SELECT CAST(least(floor((v - lo) / w), 59) AS INTEGER) AS bin FROM v, e)"
    " SELECT bin, " + r("any_value(lo) + bin * any_value(w)") + " AS left_edge, count(*) AS n FROM b, e GROUP BY bin",
)
def histogram_clipped(spark, sf_dir):
    return r6(P.histogram(responses(spark, sf_dir), "time_to_peak_min", 60, 0, 150), "left_edge")


@query(
    "a38_cluster_names",
    "WITH m AS (SELECT c_mktsegment, row_number() OVER (ORDER BY avg(c_acctbal), c_mktsegment) AS p FROM customer GROUP BY 1)"
    " SELECT c_custkey, CASE p WHEN 1 THEN 'Bajo registro' WHEN 2 THEN 'Moderado' ELSE 'Alto registro' END AS cluster_name"
    " FROM customer JOIN m USING (c_mktsegment)",
)
def cluster_names(spark, sf_dir):
    from sensorloom.functions.fixed import NUTRITION_CLUSTER_NAMES

    c = roles.table(spark, sf_dir, "customer")
    return P.name_clusters(c, "c_mktsegment", "c_acctbal", NUTRITION_CLUSTER_NAMES, "cluster_name").select(
        "c_custkey", "cluster_name"
    )


@query(
    "j14_global_scalar",
    "SELECT c_custkey, " + r("c_acctbal - (SELECT median(c_acctbal) FROM customer)") + " AS above_median FROM customer",
)
def scalar(spark, sf_dir):
    c = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    out = scalars(c, wide_medians(c, ["c_acctbal"], "m_"))
    return r6(out.select("c_custkey", (F.col("c_acctbal") - F.col("m_c_acctbal")).alias("above_median")), "above_median")


@query(
    "j15_group_statistic",
    RESP + "SELECT meal_id, " + r("avg(peak_value) OVER (PARTITION BY user_id)") + " AS user_mean FROM resp",
)
def group_stat(spark, sf_dir):
    df = responses(spark, sf_dir).select("meal_id", "user_id", "peak_value")
    means = df.groupBy("user_id").agg(F.avg("peak_value").alias("user_mean"))
    return r6(df.join(means, "user_id"), "user_mean").select("meal_id", "user_mean")


@query(
    "m01_zscore",
    RESP + "SELECT meal_id, " + ", ".join(
        r(f"(coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / stddev_pop(coalesce({c}, 0)) OVER ()") + f" AS {c}_z"
        for c in ("iauc", "glucose_preprandial")
    ) + " FROM resp",
)
def zscore(spark, sf_dir):
    out = D.zscore(responses(spark, sf_dir), ["iauc", "glucose_preprandial"])
    return r6(out, "iauc_z", "glucose_preprandial_z").select("meal_id", "iauc_z", "glucose_preprandial_z")


GAPS = ("glucose_preprandial", "recovery_time_min", "glucose_2h")


@query(
    "m04_impute_median",
    RESP + "SELECT meal_id, " + ", ".join(r(f"coalesce({c}, (SELECT median({c}) FROM resp))") + f" AS {c}" for c in GAPS) + " FROM resp",
)
def impute(spark, sf_dir):
    return r6(D.impute_median(responses(spark, sf_dir), GAPS), *GAPS).select("meal_id", *GAPS)


@query(
    "m05_impute_user_median",
    RESP + ", u AS (SELECT meal_id, " + ", ".join(f"coalesce({c}, median({c}) OVER (PARTITION BY user_id)) AS {c}" for c in GAPS)
    + " FROM resp) SELECT meal_id, " + ", ".join(r(f"coalesce({c}, (SELECT median({c}) FROM u), 0)") + f" AS {c}" for c in GAPS)
    + " FROM u",
)
def impute_user(spark, sf_dir):
    df = durable(responses(spark, sf_dir).select("meal_id", "user_id", *GAPS))
    return r6(D.impute_user_median(df, GAPS), *GAPS).select("meal_id", *GAPS)


@query(
    "m06_group_folds",
    "WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), d AS (SELECT *, (row_number() OVER (ORDER BY n DESC,"
    " md5('folds:' || user_id), user_id) - 1) % 10 AS t FROM u) SELECT user_id, CAST(CASE WHEN t < 5 THEN t ELSE 9 - t END AS INTEGER)"
    " AS fold, n FROM d",
)
def folds(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("user_id")
    return D.group_folds(e).groupBy("user_id", "fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m06_dealt_folds",
    "WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), d AS (SELECT *, (row_number() OVER (ORDER BY n DESC,"
    " md5('folds:' || user_id), user_id) - 1) % 10 AS t FROM u) SELECT CAST(CASE WHEN t < 5 THEN t ELSE 9 - t END AS INTEGER)"
    " AS fold, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_users FROM d GROUP BY 1",
)
def dealt(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("user_id")
    return D.group_folds(e).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users")
    )


@query("t01_stored_order", "SELECT user_id, ts, event_id, value FROM events")
def stored(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return e.repartitionByRange("user_id", "ts").sortWithinPartitions("user_id", "ts")


@query("t02_order_by_metric", "SELECT p_partkey, p_retailprice, p_size FROM part ORDER BY p_retailprice, p_size DESC, p_partkey")
def ordered(spark, sf_dir):
    p = roles.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    return p.orderBy("p_retailprice", F.desc("p_size"), "p_partkey")


@query("t03_top_k", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 15")
def top(spark, sf_dir):
    p = roles.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return p.orderBy(F.desc("p_retailprice"), "p_partkey").limit(15)

