"""What surrounds an event: activity, questionnaires, earlier events, the user."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed
from sensorloom.functions.columns import US_PER_DAY, US_PER_HOUR, US_PER_MIN
from sensorloom.operators.ranks import exact_quantiles
from sensorloom.operators.response import time_in_range
from sensorloom.operators.temporal import centre, first_row, interval_agg, rolling_moments, spread
from sensorloom.session import durable


def prior_activity(events: DataFrame, sport: DataFrame, scale: int = 1, key: str = "meal_id",
                   user: str = "user_id", salt: int = 1) -> DataFrame:
    """Sessions before each event: the 24 h bundle and the 2, 6 and 48 h windows.

    One join at 48 h; the shorter windows are conditions. `sport`: user, r_us,
    duration, intensity_category.
    """
    hour = US_PER_HOUR * scale
    short, mid, long = (h * hour for h in fixed.ACTIVITY_MULTI_HOURS)
    day = fixed.ACTIVITY_HOURS * hour
    d = F.col("us") - F.col("r_us")
    level, duration = F.col("intensity_category"), F.col("duration")
    in_day = d <= day
    score = C.intensity_score(level)
    minutes = F.coalesce(duration, F.lit(0.0))
    w = interval_agg(
        events,
        sport.select(user, "r_us", "duration", "intensity_category"),
        key,
        [user],
        -long,
        0,
        [
            F.sum(F.when(in_day, duration)).alias("_d24"),
            F.count(F.when(in_day, F.lit(1))).alias("_n24"),
            F.bool_or(in_day & (level == "high")).alias("_high"),
            F.bool_or(in_day & (level == "moderate")).alias("_moderate"),
            F.max(F.when(in_day, F.col("r_us"))).alias("_last"),
            F.sum(F.when(d <= short, duration)).alias("_d2"),
            F.sum(F.when(d <= mid, duration)).alias("_d6"),
            F.sum(duration).alias("_d48"),
            F.count(F.lit(1)).alias("_n48"),
            F.sum(score * minutes).alias("_weighted"),
            F.sum(minutes).alias("_minutes"),
            F.avg(score).alias("_plain"),
        ],
        closed="left",
        salt=salt,
    )
    zero = F.lit(0.0)
    return events.join(w, key, "left").select(
        *events.columns,
        F.coalesce("_d24", zero).alias("sport_prior_duration"),
        F.coalesce("_n24", F.lit(0)).alias("sport_prior_sessions"),
        F.when(F.col("_n24") > 0, F.when(F.col("_high"), "high").when(F.col("_moderate"), "moderate").otherwise("low"))
        .otherwise("none").alias("sport_prior_intensity"),
        ((F.col("us") - F.col("_last")) / F.lit(float(hour))).alias("hours_since_last_sport"),
        F.coalesce("_d2", zero).alias("sport_2h_duration"),
        F.coalesce("_d6", zero).alias("sport_6h_duration"),
        F.coalesce("_d48", zero).alias("sport_48h_duration"),
        F.coalesce("_n48", F.lit(0)).alias("sport_48h_sessions"),
        F.coalesce(
            F.when(F.col("_minutes") > 0, F.col("_weighted") / F.col("_minutes")).otherwise(F.col("_plain")),
            zero,
        ).alias("sport_intensity_score"),
    )


def daily_answers(events: DataFrame, answers: DataFrame, names: Mapping[str, str], flag: tuple[str, str],
                  lag_days: int = 0, user: str = "user_id", ts: str = "ts", order: str = "id") -> DataFrame:
    """First questionnaire of the event's UTC date (or of a date before it).

    `names` maps answer columns to output columns; `flag` is a boolean one that
    is false where nothing was answered.
    """
    dated = answers.select(user, F.to_date(ts).alias("_date"), ts, order, *names, flag[0])
    first = first_row(dated, [user, "_date"], [ts, order]).select(
        user, "_date", *[F.col(c).alias(n) for c, n in names.items()], F.col(flag[0]).alias("_flag"),
    )
    day = events.withColumn("_date", F.date_sub(F.to_date(ts), lag_days))
    return day.join(first, [user, "_date"], "left").select(
        *events.columns, *names.values(), F.coalesce("_flag", F.lit(False)).alias(flag[1])
    )


def with_calendar(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": C.day_of_week(ts),
            "is_weekend": C.is_weekend(ts),
            "meal_period": C.day_period(F.hour(ts)),
        }
    )


def user_stats(readings: DataFrame, user: str = "user_id", value: str = "r_value") -> DataFrame:
    """Mean, spread, quartiles and time in range per user.

    The quartiles come from counts of value ranges, so no task holds a user's values whole.
    """
    q = exact_quantiles(readings, [value], [0.25, 0.5, 0.75], [user])
    quart = q.groupBy(user).agg(
        *[
            F.max(F.when(F.col("q") == share, F.col("value"))).alias(name)
            for name, share in (("user_glucose_q25", 0.25), ("user_glucose_median", 0.5), ("user_glucose_q75", 0.75))
        ]
    )
    plain = readings.groupBy(user).agg(
        F.avg(value).alias("user_glucose_mean"),
        F.stddev_samp(value).alias("user_glucose_std"),
        time_in_range(value).alias("user_time_in_range"),
    )
    return plain.join(quart, user, "left").select(
        user,
        "user_glucose_mean",
        "user_glucose_std",
        "user_glucose_median",
        "user_glucose_q25",
        "user_glucose_q75",
        "user_time_in_range",
    )


def rolling_response(events: DataFrame, scale: int = 1, key: str = "meal_id", user: str = "user_id",
                     safe: bool = False) -> DataFrame:
    """Key and rolling response of earlier events (30 d).

    `safe` admits an earlier event only once its response window has passed.
    """
    # [t - 30 d, t), or up to t - response window for `safe`
    delay = fixed.POST_MIN * US_PER_MIN * scale if safe else 1
    past = events.select(user, F.col("us").alias("r_us"), "peak_value", "time_to_peak_min")
    found = rolling_moments(
        events.select(key, user, (F.col("us") - delay + 1).alias("us")),
        past, key, [user], fixed.ROLL_MEALS_DAYS * US_PER_DAY - delay + 1, ["peak_value", "time_to_peak_min"],
    )
    enough = F.col("n_rows") >= fixed.ROLL_MEALS_MIN
    return found.select(
        key,
        F.when(enough, centre("peak_value")).alias("user_peak_mean_roll"),
        F.when(enough, spread("peak_value")).alias("user_peak_std_roll"),
        F.when(enough, centre("time_to_peak_min")).alias("user_ttp_mean_roll"),
    )


def rolling_readings(events: DataFrame, readings: DataFrame, key: str = "meal_id", user: str = "user_id") -> DataFrame:
    """Key and rolling readings (14 d) before each event."""
    found = rolling_moments(
        events, readings.select(user, "r_us", "r_value"), key, [user], fixed.ROLL_READINGS_DAYS * US_PER_DAY, ["r_value"]
    )
    enough = F.col("n_rows") >= fixed.ROLL_READINGS_MIN
    return found.select(
        key,
        F.when(enough, centre("r_value")).alias("user_glucose_mean_roll"),
        F.when(enough, spread("r_value")).alias("user_glucose_std_roll"),
    )


def rolling_user(events: DataFrame, readings: DataFrame, scale: int = 1, key: str = "meal_id",
                 user: str = "user_id", safe: bool = False) -> DataFrame:
    """Both rolling states beside the events' own columns."""
    events = durable(events)  # read by both windows and the result
    meals = rolling_response(events, scale, key, user, safe)
    return events.join(meals, key, "left").join(rolling_readings(events, readings, key, user), key, "left")


def same_day(events: DataFrame, user: str = "user_id", ts: str = "ts", carbs: str = "total_carbs",
             peak: str = "peak_value", safe_delay: int = 0) -> DataFrame:
    """State of the day before each event: count, top peak, carbs, hours since the last.

    A group is one user's events of one UTC date. With `safe_delay` (micros) the
    peak counts only events whose response window has passed.
    """
    day = Window.partitionBy(user, F.to_date(ts)).orderBy("us")
    earlier = day.rangeBetween(Window.unboundedPreceding, -1)
    known = day.rangeBetween(Window.unboundedPreceding, -max(safe_delay, 1))
    return events.select(
        "*",
        F.count(F.lit(1)).over(earlier).alias("prev_meals_today"),
        F.max(peak).over(known).alias("prev_peak_today_max"),
        ((F.col("us") - F.max("us").over(earlier)) / F.lit(float(US_PER_HOUR))).alias("hours_since_last_meal"),
        F.coalesce(F.sum(carbs).over(earlier), F.lit(0.0)).alias("carbs_load_today"),
    )
