"""The batch plan: cleaned tables to feature tables, stage by stage.

Stages take and give DataFrames and stay lazy; `run_batch` writes each to Parquet,
so that a stage is computed once and its layout is known to the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.operators import clean, context, nutrition
from sensorloom.operators.folds import group_folds, impute_user_median
from sensorloom.operators.ranks import label_codes
from sensorloom.operators.response import pre_window, response
from sensorloom.session import durable, scratch_dir
from sensorloom.sources import io

SLEEP_NAMES = {
    "sleep_time": "sleep_time_prev", "sleep_quality": "sleep_quality_prev", "tiredness": "tiredness",
    "fasting_hunger": "fasting_hunger", "resting_hr": "resting_hr_morning", "hr_variability": "hrv_morning",
    "glucose_basal": "glucose_basal_quest",
}
EVENING_NAMES = {
    "trainning_effort": "training_effort_prev", "anxiety_level": "anxiety_prev",
    "nutrition_plan": "nutrition_plan_prev", "day_evaluation": "day_eval_prev",
}


@dataclass(frozen=True)
class Tables:
    """Inputs of the feature stages.

    meals: meal_id, user_id, ts, us, meal_type · readings: user_id, r_us, r_value, r_id ·
    sport: user_id, r_us, duration, intensity_category · morning, night: user_id, ts, id
    and their answers · nutrition: meal_id and the nutrition columns.
    """

    meals: DataFrame
    readings: DataFrame
    sport: DataFrame
    morning: DataFrame
    night: DataFrame
    nutrition: DataFrame


def from_clean(t: dict[str, DataFrame]) -> Tables:
    """Adapt the cleaned raw tables."""
    foods = nutrition.unique_foods(t["foods"].withColumn("row_id", F.xxhash64(*t["foods"].columns)))
    meals = t["meals"].where("has_items").where(F.col("timestamp").isNotNull())

    def answers(df: DataFrame) -> DataFrame:
        # the tables have no id; rows equal in time are told apart by a hash of the row
        return df.withColumnRenamed("timestamp", "ts").withColumn("id", F.xxhash64(*[c for c in df.columns if c != "timestamp"]))

    return Tables(
        meals.select(
            F.col("id").alias("meal_id"), "user_id", F.col("timestamp").alias("ts"), C.micros("timestamp").alias("us"),
            F.col("type").alias("meal_type"),
        ),
        t["readings"].select(
            "user_id", C.micros("timestamp").alias("r_us"), F.col("value_decimal").alias("r_value"),
            F.xxhash64("value_decimal").alias("r_id"),
        ),
        t["sport"].select("user_id", C.micros("timestamp").alias("r_us"), "duration", "intensity_category"),
        answers(t["morning"]),
        answers(t["night"]),
        nutrition.meal_nutrition(t["items"], foods),
    )


def modeling_dataset(t: Tables, scale: int = 1) -> DataFrame:
    """One row per meal with a response: targets, calendar, activity, answers, user, nutrition."""
    meals = t.meals.join(t.nutrition.select("meal_id"), "meal_id", "left_semi")
    base = context.with_calendar(response(meals, t.readings, scale))
    acted = context.prior_activity(base, t.sport, scale)
    slept = context.daily_answers(acted, t.morning, _present(t.morning, SLEEP_NAMES), ("sickness", "is_sick"))
    evening = context.daily_answers(
        slept, t.night, _present(t.night, EVENING_NAMES), ("out_of_routine", "out_of_routine_prev"), 1
    )
    known = evening.join(context.user_stats(t.readings), "user_id", "left").join(t.nutrition, "meal_id", "left")
    front = C.existing(known.columns, ["meal_id", "user_id", "ts", "us", *fixed.TARGETS])
    return known.select(*front, *[c for c in known.columns if c not in front])


def _present(df: DataFrame, names: dict[str, str]) -> dict[str, str]:
    return {c: n for c, n in names.items() if c in df.columns}


def peak_dataset(base: DataFrame, t: Tables, scale: int = 1, safe: bool = False) -> DataFrame:
    """Adds the windows before the meal, interactions, rolling and same-day state.

    The multi-window activity columns are in `base` already: they come out of the
    same join as the 24 h bundle.
    """
    delay = fixed.POST_MIN * C.US_PER_MIN * scale if safe else 0
    pre = pre_window(base, t.readings, scale)
    rolled = context.rolling_user(pre, t.readings, scale, safe=safe)
    day = context.same_day(rolled, safe_delay=delay)
    return nutrition.interactions_late(nutrition.interactions_peak(day))


def feature_columns(df: DataFrame, production: bool = True, late: bool = False) -> list[str]:
    """Feature list of the peak model, or of the late/fast model."""
    pre = fixed.PRE_BEST_FEATURES if production else fixed.PRE_FEATURES
    wanted = [
        *fixed.BASE_FEATURES, *[f"{c}_enc" for c in fixed.CATEGORICAL_FEATURES], *pre, *fixed.NUTRITION_FEATURES,
        *fixed.SPORT_FEATURES, *fixed.ROLLING_FEATURES, *fixed.DAY_FEATURES, "nutri_cluster_num", "glyc_cluster_num",
        *(fixed.LATE_FEATURES if late else []),
    ]
    return C.existing(df.columns, wanted)


def with_codes(df: DataFrame) -> DataFrame:
    for c in C.existing(df.columns, fixed.CATEGORICAL_FEATURES):
        df = label_codes(df, c, f"{c}_enc")
    return df


def training_table(df: DataFrame, columns: list[str], target: str, keep: list[str], k: int = 5) -> DataFrame:
    """Imputed features, label and user-disjoint fold, made durable for the fits."""
    rows = durable(
        df.select(*dict.fromkeys(["meal_id", "user_id", *keep]), *[F.col(c).cast("double").alias(c) for c in columns],
                  F.col(target).cast("double").alias("label"))
    )
    return durable(group_folds(impute_user_median(rows, columns), k))


def run_batch(spark: SparkSession, source: str, target: str, scale: int = 1) -> dict[str, DataFrame]:
    """Raw CSV folder to cleaned tables, audit log, quality flags and both feature tables.

    The audit log and the row counts are taken while the cleaned tables are written: each raw table is read once.
    """
    raw = {n: io.timed(io.read_raw(spark, source, n)) for n in io.RAW if n != "event"}
    parse = clean.parse_rules()
    rules = {
        "glucose": parse + clean.reading_rules(raw["glucose"], ts="_ts"),
        "meal": parse,
        "meal_item": clean.item_rules(),
        "sport": parse + clean.activity_rules(raw["sport"], ts="_ts"),
        "questionnaire_morning": parse + clean.morning_rules(),
        "questionnaire_night": parse,
    }
    before = {n: clean.Watch(n, rs) for n, rs in rules.items()}
    made = io.cleaned({n: before[n].on(df) if n in before else df for n, df in raw.items()})
    after = {"meals": clean.Watch("meal", clean.flag_rules())}
    after |= {n: clean.Watch(n) for n in made if n != "meals"}
    made = {n: df if n == "meals" else after[n].on(df) for n, df in made.items()}
    stored = {}
    for name, df in made.items():
        path = f"{target}/{name}"
        if name in ("readings", "meals"):
            # a plain write first: a sort's sample or a stage run again would count rows twice
            first = f"{scratch_dir(spark)}/{name}"
            io.write_table(df, first)
            df = io.read_table(spark, first)
        if name == "readings":
            io.write_series(df, path, "user_id", "timestamp")
        elif name == "meals":  # the flag comes from the items that are written already
            flagged = clean.flag_exists(df, stored["items"], "id", "meal_id")
            io.write_table(after[name].on(flagged), path)
        else:
            io.write_table(df, path)
        stored[name] = io.read_table(spark, path)
    log = after["meals"].log(spark)
    for watch in before.values():
        log = log.unionByName(watch.log(spark))
    io.write_table(log, f"{target}/cleaning_log")
    pairs = {"glucose": "readings", "meal": "meals", "meal_item": "items", "sport": "sport"}
    io.write_table(
        spark.createDataFrame(
            [(n, before[n].rows, after[m].rows, after[m].rows - before[n].rows) for n, m in pairs.items()],
            'table string, n_before long, n_after long, delta long',
        ),
        f"{target}/row_counts",
    )
    io.write_table(
        clean.user_quality(stored["readings"], stored["meals"], stored["sport"], stored["morning"], stored["night"]),
        f"{target}/user_quality",
    )
    tables = from_clean(stored)
    io.write_table(modeling_dataset(tables, scale), f"{target}/modeling_dataset")
    base = io.read_table(spark, f"{target}/modeling_dataset")
    peak = peak_dataset(base, tables, scale)
    io.write_table(peak, f"{target}/modeling_dataset_peak")
    names = [*made, "cleaning_log", "row_counts", "user_quality", "modeling_dataset", "modeling_dataset_peak"]
    return {n: io.read_table(spark, f"{target}/{n}") for n in names}
