"""Meal nutrition from items and the food table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import columns as C
from sensorloom.operators.temporal import first_row


def unique_foods(foods: DataFrame, order: str = "row_id") -> DataFrame:
    """First row of each food, by a total order."""
    return first_row(foods, ["food_id"], [order]).drop(order)


def meal_nutrition(items: DataFrame, foods: DataFrame) -> DataFrame:
    """One row per meal: sums, flags, fibre, attributes and ratios.

    One join to the food table and one aggregate serve the sums, the fibre block
    and the attribute block. The food table is joined by size: AQE broadcasts it
    while it is small.
    """
    rows = items.join(foods, "food_id", "left")
    fibre = F.col("fibre_gram_value")
    sugar = F.count_if(F.lower(F.trim(F.col("atri_sugar_add").cast("string"))) == "true") if (
        "atri_sugar_add" in foods.columns
    ) else F.lit(0).cast("long")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0.0))

    out = rows.groupBy("meal_id").agg(
        total("calories").alias("total_calories"),
        total("protein").alias("total_protein"),
        total("fat").alias("total_fat"),
        total("carbs").alias("total_carbs"),
        F.count("id").alias("n_items"),
        F.bool_or(F.col("calories").isNull()).alias("has_nan_calories"),
        F.bool_or(F.col("protein").isNull()).alias("has_nan_macros"),
        total(fibre * F.col("amount") / 100).alias("total_fibre"),
        F.bool_or(fibre.isNotNull()).alias("fibre_available"),
        F.avg(fibre.isNotNull().cast("double")).alias("pct_items_with_fibre"),
        F.count_if(C.is_flag("atri_ultraprocessed")).alias("n_ultraprocessed"),
        F.count_if(C.is_flag("atri_high_glycemic_index")).alias("n_high_gi"),
        sugar.alias("n_sugar_added"),
        F.avg("saturated_fatty_acid").alias("avg_saturated_fat"),
        # food groups are few, so a set merges map-side where a distinct count
        # would copy every row to a second shuffle
        F.size(F.collect_set("food_group_id")).cast("long").alias("n_food_groups"),
    )
    kcal = "total_calories"
    return out.withColumns(
        {
            "pct_cal_carbs": C.energy_share("total_carbs", 4, kcal),
            "pct_cal_protein": C.energy_share("total_protein", 4, kcal),
            "pct_cal_fat": C.energy_share("total_fat", 9, kcal),
            "fibre_carb_ratio": C.ratio("total_fibre", "total_carbs"),
        }
    )


def interactions_basic(df: DataFrame) -> DataFrame:
    """Interaction features of the first models; medians fill two of them."""
    from sensorloom.operators.ranks import scalars, wide_medians

    ratio = C.ratio("total_fat", "total_protein")
    with_ratio = df.withColumn("fat_protein_ratio", ratio)
    medians = wide_medians(with_ratio, ["glucose_preprandial", "fat_protein_ratio"], "_m_")
    out = scalars(with_ratio, medians).withColumns(
        {
            "net_carbs": C.net_carbs("total_carbs", "total_fibre", clipped=False),
            "carbs_x_hour": F.col("total_carbs") * F.col("hour_of_day"),
            "carbs_x_preprandial": F.col("total_carbs")
            * F.coalesce("glucose_preprandial", "_m_glucose_preprandial"),
            "fat_protein_ratio": F.coalesce("fat_protein_ratio", "_m_fat_protein_ratio"),
        }
    ).drop("_m_glucose_preprandial", "_m_fat_protein_ratio")
    for c in ("nutri_cluster", "glyc_cluster"):
        if c in df.columns:
            out = out.withColumn(f"{c}_num", F.coalesce(F.col(c).cast("int"), F.lit(0)))
    return out


def interactions_peak(df: DataFrame) -> DataFrame:
    """Interaction features of the peak models."""
    return df.withColumns(
        {
            "net_carbs": C.net_carbs("total_carbs", "total_fibre"),
            "pct_high_gi_items": C.ratio("n_high_gi", "n_items"),
            "fat_delay_score": F.col("total_fat") * F.col("total_carbs"),
            "effective_gi_score": C.effective_gi("n_high_gi", "pct_cal_fat"),
            "carbs_per_item": C.ratio("total_carbs", "n_items"),
        }
    )


def interactions_late(df: DataFrame) -> DataFrame:
    """Interaction features of the late/fast model."""
    score = F.coalesce("sport_intensity_score", F.lit(0.0)) if "sport_intensity_score" in df.columns else F.lit(0.0)
    return df.withColumns(
        {
            "fat_carb_ratio_meal": F.coalesce(C.ratio("total_fat", "total_carbs"), F.lit(0.0)),
            "gi_fiber_interaction": C.gi_fibre("n_high_gi", "fibre_carb_ratio"),
            "sport_2h_insulin_proxy": F.coalesce("sport_2h_duration", F.lit(0.0)) * score,
        }
    )


def food_usage(foods: DataFrame, items: DataFrame, name: str = "food_esp_name") -> DataFrame:
    """How often each food name is used in items, 0 where never."""
    used = items.groupBy(C.title_case("food_name").alias("_name")).agg(F.count(F.lit(1)).alias("freq"))
    named = foods.withColumn(name, C.title_case(name))
    return named.join(used, named[name] == F.col("_name"), "left").select(
        *named.columns, F.coalesce("freq", F.lit(0)).alias("freq")
    )


def food_table(foods: DataFrame, items: DataFrame) -> DataFrame:
    """Food table for meal entry: tidy names and numbers, most used row per name."""
    wanted = foods.na.drop(
        subset=["food_esp_name", "carbohydrate_gram_value", "fat_grams_value", "protein_gram_value"]
    )
    tidy = wanted.select(
        "food_id",
        "food_esp_name",
        F.col("carbohydrate_gram_value").alias("carbs_100g"),
        F.col("fat_grams_value").alias("fat_100g"),
        F.col("protein_gram_value").alias("protein_100g"),
        F.coalesce("fibre_gram_value", F.lit(0.0)).alias("fibre_100g"),
        F.when(C.is_flag("atri_high_glycemic_index"), 1.0)
        .otherwise(C.flag01("atri_high_glycemic_index")).alias("high_gi"),
        F.when(C.is_flag("atri_ultraprocessed"), 1.0)
        .otherwise(C.flag01("atri_ultraprocessed")).alias("ultraprocessed"),
        F.coalesce("saturated_fatty_acid", F.lit(0.0)).alias("saturated_fat_100g"),
        C.bound_number("portion", 100.0, 5.0, 500.0).alias("portion_default"),
    )
    used = food_usage(tidy, items)
    return first_row(used, ["food_esp_name"], [-F.col("freq"), "food_id"])


def meal_totals(selections: DataFrame, foods: DataFrame, scaled_fat: bool = True) -> DataFrame:
    """Totals of chosen foods and grams per meal.

    Unknown foods and non-positive grams are left out, but the meal stays. The
    saturated fat is the mean of grams eaten, or with `scaled_fat=False` the mean
    per 100 g as in training.
    """
    share = F.col("grams") / 100
    rows = selections.where(F.col("grams") > 0).join(foods, "food_esp_name")
    fat = F.col("saturated_fat_100g")
    totals = rows.groupBy("meal_id").agg(
        F.sum(F.col("carbs_100g") * share).alias("carbs"),
        F.sum(F.col("fat_100g") * share).alias("fat"),
        F.sum(F.col("protein_100g") * share).alias("protein"),
        F.sum(F.col("fibre_100g") * share).alias("fibre"),
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(F.col("high_gi") >= 0.5).alias("n_high_gi"),
        F.count_if(F.col("ultraprocessed") >= 0.5).alias("n_ultraprocessed"),
        F.avg(fat * share if scaled_fat else fat).alias("avg_sat_fat"),
    )
    return selections.select("meal_id").distinct().join(totals, "meal_id", "left").na.fill(
        0.0, ["carbs", "fat", "protein", "fibre", "avg_sat_fat"]
    ).na.fill(0, ["n_items", "n_high_gi", "n_ultraprocessed"])
