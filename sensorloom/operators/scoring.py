"""Feature rows for scoring requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.operators.nutrition import interactions_late, interactions_peak
from sensorloom.operators.ranks import scalars


def requested_meals(requests: DataFrame) -> DataFrame:
    """Requests in the columns of the feature tables, with the features that these derive from them."""
    meals = requests.withColumnsRenamed(fixed.REQUEST_COLUMNS)
    energy = sum(F.col(f"total_{part}") * kcal for part, kcal in fixed.ENERGY.items())
    meals = meals.withColumn("total_calories", F.greatest(energy, F.lit(1.0)))
    shares = {f"pct_cal_{part}": C.energy_share(f"total_{part}", kcal, "total_calories") for part, kcal in fixed.ENERGY.items()}
    meals = meals.withColumns({**shares, "fibre_carb_ratio": C.ratio("total_fibre", "total_carbs")})
    meals = interactions_late(interactions_peak(meals))
    # without items all carbohydrates count as one
    return meals.withColumn("carbs_per_item", F.coalesce("carbs_per_item", "total_carbs"))


def before_meal(meals: DataFrame) -> DataFrame:
    """Columns of the pre-meal windows, from the one level and the one slope that a request states."""
    level, slope = F.col("glucose_preprandial"), F.col("cgm_slope")
    inside, above = level.between(fixed.TARGET_LO, fixed.TARGET_HI), level > fixed.TARGET_HI
    windows = {f"cgm_slope_{w}": slope for w in fixed.SLOPE_MINUTES}
    windows |= {f"cgm_delta_{w}": slope * minutes for w, minutes in fixed.SLOPE_MINUTES.items()}
    windows["cgm_tir_pre"] = F.when(inside, 100.0).otherwise(0.0)
    windows["cgm_pct_above_target"] = F.when(above, 100.0).otherwise(0.0)
    windows["n_readings_pre_60m"] = F.lit(fixed.STAND_INS["n_readings_pre_60m"])
    return meals.withColumns(windows)


def period_codes(meals: DataFrame) -> DataFrame:
    return meals.withColumns(
        {
            "hour_of_day": C.map_values("period", fixed.MEAL_PERIOD_HOURS),
            "meal_period_enc": C.map_values("period", fixed.MEAL_PERIOD_CODES),
            "meal_type_enc": C.map_values("period", fixed.MEAL_TYPE_CODES),
        }
    )


def feature_rows(requests: DataFrame, defaults: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Defaults overridden by what a request states or implies; what neither has is 0.

    `requests`: meal_id, glucose_preprandial, carbs, fat, protein, fibre, n_items,
    n_high_gi, n_ultraprocessed, avg_sat_fat, cgm_slope, sport_2h, sport_6h,
    sport_intensity, period. `defaults` is a one-row table.
    """
    meals = period_codes(before_meal(requested_meals(requests)))
    rows = scalars(meals, defaults.select(*[F.col(c).alias(f"_d_{c}") for c in defaults.columns]))

    def value(name: str):
        if name in meals.columns:
            return F.col(name)
        last = F.lit(fixed.STAND_INS.get(name, 0.0)) if name in fixed.SPREADS else F.lit(0.0)
        return F.coalesce(F.col(f"_d_{name}"), last) if name in defaults.columns else last

    filled = [F.coalesce(value(name).cast("double"), F.lit(0.0)).alias(name) for name in wanted]
    return rows.select("meal_id", *filled)
