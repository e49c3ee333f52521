"""Meal nutrition, joins to the food table, interaction features, food names."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import columns as C
from sensorloom.operators import nutrition as N
from sensorloom.operators.temporal import first_row
from sensorloom.plans.q_clean import FLAGGED, flagged
from sensorloom.plans.q_context import ACT_SQL
from sensorloom.plans.q_response import PARTS, r6, responses
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import CTES, ctes, r
from sensorloom.sources import roles

NUTRITION = ctes("nutrition")


def nutrition(spark, sf_dir):
    return N.meal_nutrition(roles.items(spark, sf_dir), roles.foods(spark, sf_dir))


def _nutrition(name, *cols, plain=(), digits=6):
    sql = NUTRITION + "SELECT " + ", ".join(["meal_id", *plain, *[f"{r(c, digits)} AS {c}" for c in cols]]) + " FROM nutrition"

    @query(name, sql)
    def run(spark, sf_dir):
        rounded = [(F.round(c, digits) + F.lit(0.0)).alias(c) for c in cols]
        return nutrition(spark, sf_dir).select("meal_id", *plain, *rounded)


_nutrition("a04_macro_sums", "total_calories", "total_protein", "total_fat", "total_carbs", plain=("n_items",))
_nutrition("a05_null_flags", plain=("has_nan_calories", "has_nan_macros"))
_nutrition("a06_fibre", "total_fibre", "pct_items_with_fibre", plain=("fibre_available",))
# a mean over a power of two items ends on a 5 at the sixth digit or so
_nutrition("a07_attributes", "avg_saturated_fat", plain=("n_ultraprocessed", "n_high_gi", "n_food_groups"), digits=9)
_nutrition("e01_safe_ratio", "fibre_carb_ratio")
_nutrition("e07_energy_shares", "pct_cal_carbs", "pct_cal_protein", "pct_cal_fat", "fibre_carb_ratio")


@query(
    "j01_left_join",
    NUTRITION + "SELECT o_orderkey AS id, n_items, " + r("total_calories")
    + " AS total_calories FROM orders LEFT JOIN nutrition ON meal_id = o_orderkey",
)
def left_join(spark, sf_dir):
    n = nutrition(spark, sf_dir).withColumnRenamed("meal_id", "id")
    out = roles.order_meals(spark, sf_dir).join(n, "id", "left")
    return r6(out, "total_calories").select("id", "n_items", "total_calories")


@query(
    "j02_inner_join",
    NUTRITION + f"SELECT id, user_id, n_items, {r('total_carbs')} AS total_carbs FROM ({FLAGGED}) m"
    " JOIN nutrition n ON m.id = n.meal_id WHERE has_items",
)
def inner_join(spark, sf_dir):
    m = flagged(spark, sf_dir).where("has_items")
    n = nutrition(spark, sf_dir)
    return r6(m.join(n, m.id == n.meal_id), "total_carbs").select("id", "user_id", "n_items", "total_carbs")


@query(
    "j03_fibre_lookup",
    ctes("items", "foods") + "SELECT meal_id, food_id, id, fibre_gram_value AS fibre_per_100g, "
    + r("fibre_gram_value * amount / 100") + " AS fibre_grams FROM items LEFT JOIN foods USING (food_id)",
)
def fibre_lookup(spark, sf_dir):
    lookup = roles.foods(spark, sf_dir).select("food_id", F.col("fibre_gram_value").alias("fibre_per_100g"))
    out = roles.items(spark, sf_dir).join(lookup, "food_id", "left")
    return r6(
        out.select("meal_id", "food_id", "id", "fibre_per_100g", (F.col("fibre_per_100g") * F.col("amount") / 100).alias("fibre_grams")),
        "fibre_grams",
    )


@query(
    "j04_attributes",
    "SELECT l_orderkey AS meal_id, l_partkey AS food_id, l_linenumber AS id, p_type = 'ECONOMY' AS ultra,"
    " CAST(p_size AS BIGINT) AS food_group_id FROM lineitem LEFT JOIN part ON p_partkey = l_partkey",
)
def attributes(spark, sf_dir):
    foods = roles.foods(spark, sf_dir).select(
        "food_id", C.is_flag("atri_ultraprocessed").alias("ultra"), "food_group_id"
    )
    return roles.raw_items(spark, sf_dir).join(foods, "food_id", "left").select(
        "meal_id", "food_id", "id", "ultra", "food_group_id"
    )


@query(
    "w02_first_row",
    "SELECT l_orderkey AS meal_id, l_linenumber AS id, arg_min(l_partkey, (l_partkey, l_suppkey, l_quantity)) AS food_id"
    " FROM lineitem GROUP BY l_orderkey, l_linenumber",
)
def first_per_key(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("meal_id"), F.col("l_linenumber").alias("id"), F.col("l_partkey").alias("food_id"),
        "l_suppkey", "l_quantity",
    )
    return first_row(rows, ["meal_id", "id"], ["food_id", "l_suppkey", "l_quantity"]).select("meal_id", "id", "food_id")


JOINED = {**PARTS, "items": CTES["items"], "foods": CTES["foods"], "nutr": CTES["nutr"], "nutrition": CTES["nutrition"],
          "ds": "SELECT r.*, hour(r.ts) AS hour_of_day, n.* EXCLUDE (meal_id) FROM resp r JOIN nutrition n USING (meal_id)"}
JOINED = {"raw_items": CTES["raw_items"], **JOINED}
DS = ctes("readings", "meals", extra=JOINED)


def joined(spark, sf_dir):
    """Events with a response, nutrition (items by the same key) and the hour."""
    n = nutrition(spark, sf_dir)
    return responses(spark, sf_dir).withColumn("hour_of_day", F.hour("ts")).join(n, "meal_id")


@query(
    "e08_interactions_basic",
    DS + ", m AS (SELECT median(glucose_preprandial) AS g, median(total_fat / nullif(total_protein, 0)) AS q FROM ds)"
    f" SELECT meal_id, {r('total_carbs - coalesce(total_fibre, 0)')} AS net_carbs, {r('total_carbs * hour_of_day')}"
    f" AS carbs_x_hour, {r('total_carbs * coalesce(glucose_preprandial, g)', 8)} AS carbs_x_preprandial,"
    f" {r('coalesce(total_fat / nullif(total_protein, 0), q)')} AS fat_protein_ratio,"
    " CAST(coalesce(nullif(n_items, 1), 0) AS INTEGER) AS nutri_cluster_num FROM ds, m",
)
def basic(spark, sf_dir):
    ds = joined(spark, sf_dir).withColumn("nutri_cluster", F.nullif("n_items", F.lit(1)))
    cols = ("net_carbs", "carbs_x_hour", "fat_protein_ratio")
    # a product of four and three decimals
    product = F.round("carbs_x_preprandial", 8) + F.lit(0.0)
    out = r6(N.interactions_basic(ds), *cols)
    return out.select("meal_id", *cols, product.alias("carbs_x_preprandial"), "nutri_cluster_num")


PEAK = {
    "net_carbs": "greatest(total_carbs - coalesce(total_fibre, 0), 0)",
    "pct_high_gi_items": "n_high_gi / nullif(n_items, 0)",
    "fat_delay_score": "total_fat * total_carbs",
    "effective_gi_score": "n_high_gi * (1 - least(greatest(coalesce(pct_cal_fat, 0) / 100, 0), 1))",
    "carbs_per_item": "total_carbs / nullif(n_items, 0)",
}


# the product is in the millions, the quotients end on a 5 at the seventh digit or so
PEAK_DIGITS = {c: 6 if c == "fat_delay_score" else 9 for c in PEAK}


@query(
    "e09_interactions_peak",
    NUTRITION + "SELECT meal_id, " + ", ".join(f"{r(e, PEAK_DIGITS[n])} AS {n}" for n, e in PEAK.items()) + " FROM nutrition",
)
def peak(spark, sf_dir):
    out = N.interactions_peak(nutrition(spark, sf_dir))
    return out.select("meal_id", *[(F.round(c, PEAK_DIGITS[c]) + F.lit(0.0)).alias(c) for c in PEAK])


@query("e02_clip", NUTRITION + f"SELECT meal_id, {r(PEAK['net_carbs'])} AS net_carbs, "
       + r("least(greatest(total_fibre, 5), 50)") + " AS fibre_clipped FROM nutrition")
def clipped(spark, sf_dir):
    n = nutrition(spark, sf_dir)
    return r6(
        n.select("meal_id", C.net_carbs("total_carbs", "total_fibre").alias("net_carbs"),
                 C.clip("total_fibre", 5, 50).alias("fibre_clipped")),
        "net_carbs", "fibre_clipped",
    )


@query(
    "e03_log",
    NUTRITION + f"SELECT meal_id, {r('ln(1 + greatest(total_carbs, 0))')} AS log_carbs,"
    f" {r('greatest(exp(ln(1 + total_fibre)) - 1, 0)', 4)} AS back FROM nutrition",
)
def logs(spark, sf_dir):
    n = nutrition(spark, sf_dir)
    out = n.select("meal_id", C.log_floor("total_carbs").alias("log_carbs"), C.unlog_floor(F.log1p("total_fibre")).alias("back"))
    return r6(out, "log_carbs").withColumn("back", F.round("back", 4) + F.lit(0.0))


LATE = {
    "fat_carb_ratio_meal": "coalesce(total_fat / nullif(total_carbs, 0), 0)",
    "gi_fiber_interaction": "n_high_gi * (1 - least(greatest(coalesce(fibre_carb_ratio, 0), 0), 1))",
    "sport_2h_insulin_proxy": "sport_2h_duration * sport_intensity_score",
}


@query(
    "e10_interactions_late",
    ACT_SQL + ", " + ", ".join(f"{n} AS ({CTES[n]})" for n in ("raw_items", "items", "foods", "nutr", "nutrition"))
    + " SELECT meal_id, " + ", ".join(f"{r(e)} AS {n}" for n, e in LATE.items()) + " FROM act JOIN nutrition USING (meal_id)",
)
def late(spark, sf_dir):
    from sensorloom.operators.context import prior_activity

    acted = prior_activity(roles.meals(spark, sf_dir), roles.sport(spark, sf_dir), roles.SCALE)
    out = N.interactions_late(acted.join(nutrition(spark, sf_dir), "meal_id"))
    return r6(out, *LATE).select("meal_id", *LATE)


TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower(trim({c})), '[[:alpha:]]+|[^[:alpha:]]+'),"
    " lambda x: upper(x[1]) || x[2:]), '')"
)


@query(
    "e16_title_case",
    "SELECT doc, title FROM (SELECT c_custkey AS doc, " + TITLE.format(c="c_name || '-' || c_mktsegment || ' o''x'")
    + " AS title FROM customer)",
)
def title(spark, sf_dir):
    c = roles.table(spark, sf_dir, "customer")
    text = F.concat(F.lit("  "), "c_name", F.lit("-"), "c_mktsegment", F.lit(" o'x "))
    return c.select(F.col("c_custkey").alias("doc"), C.title_case(text).alias("title"))


@query(
    "e17_fill",
    ctes("foods") + "SELECT food_id, coalesce(fibre_gram_value, 0.0) AS fibre_gram_value, 0.0::DOUBLE AS absent FROM foods",
)
def fill(spark, sf_dir):
    foods = roles.foods(spark, sf_dir)
    wanted = ["fibre_gram_value", "absent"]
    cols = {c: F.coalesce(c, F.lit(0.0)) if c in foods.columns else F.lit(0.0) for c in wanted}
    return foods.withColumns(cols).select("food_id", *wanted)


FREQ = "SELECT p_name AS n, count(*) AS freq FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_name"


def named_items(spark, sf_dir):
    names = roles.foods(spark, sf_dir).select("food_id", F.col("food_esp_name").alias("food_name"))
    return roles.raw_items(spark, sf_dir).join(names, "food_id").select("meal_id", "id", "food_name", "amount")


@query(
    "a39_food_usage",
    f"WITH f AS ({FREQ}) SELECT p_partkey AS food_id, {TITLE.format(c='p_name')} AS food_esp_name, coalesce(freq, 0) AS freq"
    " FROM part LEFT JOIN f ON n = p_name",
)
def usage(spark, sf_dir):
    foods = roles.foods(spark, sf_dir).select("food_id", "food_esp_name")
    return N.food_usage(foods, named_items(spark, sf_dir))


FOODS = (
    f"u AS ({FREQ}), food AS (SELECT *, row_number() OVER (PARTITION BY food_esp_name ORDER BY freq DESC, food_id) AS rn"
    f" FROM (SELECT p_partkey AS food_id, {TITLE.format(c='p_name')} AS food_esp_name, freq, p_size + 5.0 AS carbs_100g,"
    " p_size / 2.0 AS fat_100g, p_size / 4.0 AS protein_100g, coalesce(nullif(p_size, 10), 0)::DOUBLE AS fibre_100g,"
    " CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 1.0 ELSE 0 END AS high_gi,"
    " CASE WHEN p_type = 'ECONOMY' THEN 1.0 ELSE 0 END AS ultraprocessed, p_retailprice / 100 AS saturated_fat_100g,"
    " CASE WHEN p_type = 'LARGE' THEN 100.0 ELSE greatest(p_size, 5) END AS portion_default"
    " FROM part LEFT JOIN u ON n = p_name))"
)


@query(
    "t04_food_table",
    f"WITH {FOODS} SELECT food_esp_name, food_id, {r('carbs_100g')} AS carbs_100g, {r('saturated_fat_100g')} AS saturated_fat_100g,"
    f" {r('high_gi')} AS high_gi, {r('fibre_100g')} AS fibre_100g, {r('portion_default')} AS portion_default, coalesce(freq, 0) AS freq FROM food WHERE rn = 1",
)
def food_table(spark, sf_dir):
    t = N.food_table(roles.foods(spark, sf_dir), named_items(spark, sf_dir))
    cols = ("carbs_100g", "saturated_fat_100g", "high_gi", "fibre_100g", "portion_default")
    return r6(t, *cols).select("food_esp_name", "food_id", *cols, "freq")


TOTALS = {"carbs": "carbs_100g * amount / 100", "fat": "fat_100g * amount / 100", "protein": "protein_100g * amount / 100",
          "fibre": "fibre_100g * amount / 100"}


@query(
    "a40_meal_totals",
    f"WITH {FOODS}, it AS (SELECT l_orderkey AS meal_id, l_quantity * 50 - 500 AS amount, {TITLE.format(c='p_name')} AS nm"
    " FROM lineitem JOIN part ON p_partkey = l_partkey), j AS (SELECT * FROM it JOIN food ON nm = food_esp_name AND rn = 1"
    " WHERE amount > 0) SELECT m.meal_id, "
    + ", ".join(f"{r(f'coalesce(sum({e}), 0)', 4)} AS {n}" for n, e in TOTALS.items())
    + ", count(carbs_100g) AS n_items, count(*) FILTER (WHERE high_gi >= 0.5) AS n_high_gi,"
    f" {r('coalesce(avg(saturated_fat_100g * amount / 100), 0)', 9)} AS avg_sat_fat FROM (SELECT DISTINCT l_orderkey AS meal_id"
    " FROM lineitem) m LEFT JOIN j USING (meal_id) GROUP BY m.meal_id",
)
def meal_totals(spark, sf_dir):
    items = named_items(spark, sf_dir)
    food = N.food_table(roles.foods(spark, sf_dir), items)
    # ten units less, so that some selections have no grams
    chosen = items.select(
        "meal_id", C.title_case("food_name").alias("food_esp_name"), (F.col("amount") - 500).alias("grams")
    )
    t = N.meal_totals(chosen, food)
    out = t.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in TOTALS})
    fat = F.round("avg_sat_fat", 9) + F.lit(0.0)
    return out.select("meal_id", *TOTALS, "n_items", "n_high_gi", fat.alias("avg_sat_fat"))
