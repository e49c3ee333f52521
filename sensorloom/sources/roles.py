"""The given star-schema tables in the roles of the domain's tables.

`events` gives readings, meals, activity and questionnaires; `lineitem` and
`part` give meal items and foods, for `orders` and, by the same key, for meals.
Readings are sparse, so windows of minutes are taken as hours (`SCALE`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.functions import columns as C
from sensorloom.operators.clean import clean_items

SCALE = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir, "view", "click", "signup").select(
        "user_id", C.micros("ts").alias("r_us"), F.col("value").alias("r_value"), F.col("event_id").alias("r_id")
    )


def meals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir, "purchase").select(
        F.col("event_id").alias("meal_id"), "user_id", "ts", C.micros("ts").alias("us"),
        F.col("value").alias("carbs"),
    )


def sport(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.pmod(_k(), F.lit(3))
    return events(spark, sf_dir, "error").select(
        "user_id",
        C.micros("ts").alias("r_us"),
        F.nullif(F.col("value"), F.lit(0.0)).alias("duration"),
        F.when(level == 0, "low").when(level == 1, "moderate").otherwise("high").alias("intensity_category"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir, "signup").select(
        F.col("event_id").alias("id"), "user_id", "ts", F.col("value").alias("score"),
        _k().cast("double").alias("level"), (_k() >= 50).alias("flag"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("id"),
        F.col("l_orderkey").alias("meal_id"),
        F.col("l_partkey").alias("food_id"),
        (quantity * 50).alias("amount"),
        (price / 20).alias("calories"),
        (quantity * 4).alias("protein"),
        (quantity * F.col("l_discount") * 50).alias("fat"),
        (price / 100 - 60).alias("carbs"),
    )


def foods(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("food_id"),
        F.col("p_name").alias("food_esp_name"),
        size.alias("food_group_id"),
        F.nullif(size.cast("double"), F.lit(10.0)).alias("fibre_gram_value"),
        (F.col("p_retailprice") / 100).alias("saturated_fatty_acid"),
        (size.cast("double") + 5).alias("carbohydrate_gram_value"),
        (size.cast("double") / 2).alias("fat_grams_value"),
        (size.cast("double") / 4).alias("protein_gram_value"),
        F.when(F.col("p_type") == "ECONOMY", "Si").otherwise("No").alias("atri_ultraprocessed"),
        F.when(F.col("p_type").isin("PROMO", "SMALL"), "Si").otherwise("No").alias("atri_high_glycemic_index"),
        F.when(F.col("p_type") == "LARGE", F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("portion"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_items(raw_items(spark, sf_dir))


def raw_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text in mixed formats, some of them unreadable."""
    kind = F.pmod(_k(), F.lit(9))
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(kind == 0, F.concat(day, F.lit(" "), clock, F.lit("+00")))
        .when(kind == 1, F.concat(day, F.lit("T"), clock, F.lit("Z")))
        .when(kind == 2, F.concat(day, F.lit(" "), clock))
        .when(kind == 3, F.concat(day, F.lit("?"), clock))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
        .when(kind == 6, F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
        .when(kind == 7, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd hh:mm:ss a")).alias("timestamp"),
        F.col("value").alias("value_decimal"),
    )


ACTIVITY_WORDS = (
    "Correr", "Trail running", "Ciclismo", "VirtualRide", "Caminar", "Senderismo", "Natación", "WeightTraining",
    "Crossfit", "Fútbol", "Tenis", "Esquí", "NordicSki", "Elíptica", "Escalada", "EBikeRide", "Yoga", "Juggling",
)


def raw_sport(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in ACTIVITY_WORDS])
    return events(spark, sf_dir, "error").select(
        F.col("event_id").alias("id"), "user_id", F.col("ts").alias("timestamp"),
        F.get(words, F.pmod(_k(), F.lit(len(ACTIVITY_WORDS)))).alias("type"),
        # a third without a duration, some over the limit
        F.when(F.pmod(_k(), F.lit(3)) == 0, 0.0).otherwise(F.col("value") * 2).alias("duration"),
    )


def raw_morning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_nationkey") * 10.0).alias("resting_hr"),
        (F.col("c_acctbal") / 20).alias("glucose_basal"),
        (F.col("c_acctbal") / 10).alias("sleep_time"),
        (F.col("c_acctbal") / 25).alias("hr_variability"),
    )


def order_meals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("type"),
    )


def domain(spark: SparkSession, sf_dir: str):
    """All inputs of the feature stages. Meals take their items by the same key."""
    from sensorloom.operators.nutrition import meal_nutrition
    from sensorloom.plans.pipeline import Tables

    kinds = F.array(*[F.lit(w) for w in ("main", "snack", "drink")])
    timed = events(spark, sf_dir, "purchase").select(
        F.col("event_id").alias("meal_id"), "user_id", "ts", C.micros("ts").alias("us"),
        F.get(kinds, F.pmod(_k(), F.lit(3))).alias("meal_type"),
    )
    a = answers(spark, sf_dir)
    keys = ("user_id", "ts", "id")
    score, level, flag = F.col("score"), F.col("level"), F.col("flag")
    return Tables(
        timed,
        readings(spark, sf_dir),
        sport(spark, sf_dir),
        a.select(*keys, score.alias("sleep_time"), level.alias("sleep_quality"), flag.alias("sickness")),
        a.select(*keys, score.alias("trainning_effort"), level.alias("anxiety_level"), flag.alias("out_of_routine")),
        meal_nutrition(items(spark, sf_dir), foods(spark, sf_dir)),
    )


def arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
