"""Response of a series to an event: peak, area, recovery, spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import fixed
from sensorloom.functions.columns import US_PER_MIN
from sensorloom.operators.temporal import interval_agg, previous_in_series


def response(
    events: DataFrame,
    readings: DataFrame,
    scale: int = 1,
    key: str = "meal_id",
    user: str = "user_id",
    salt: int = 1,
) -> DataFrame:
    """All response measures, one row per event with enough readings after it.

    `events`: key, user, us. `readings`: user, r_us, r_value, r_id (r_id breaks ties
    in time). Windows are `scale` times the fixed minutes, and times come out in
    units of `scale` minutes.

    Two passes over the interval join, both with aggregates that merge map-side:
    the first finds baseline and peak, the second the area above the baseline and
    the recovery, which need both. Trapezoids are cut on the series once per
    reading, not once per pair.
    """
    unit = US_PER_MIN * scale
    pre, post = fixed.PRE_ASOF_MIN * unit, fixed.POST_MIN * unit
    d = F.col("r_us") - F.col("us")
    after, before = d > 0, d <= 0
    value = F.col("r_value")
    at = F.struct("r_us", "r_id")
    # greatest value, then earliest time
    top = F.struct(value, -F.col("r_us"))
    first = interval_agg(
        events,
        readings.select(user, "r_us", "r_value", "r_id"),
        key,
        [user],
        -pre,
        post,
        [
            F.max_by(F.when(before, value), F.when(before, at)).alias("glucose_preprandial"),
            F.avg(F.when(before, value)).alias("glucose_preprandial_mean"),
            F.min_by(F.when(after, value), F.when(after, at)).alias("_first"),
            F.max(F.when(after, top)).alias("_top"),
            F.count(F.when(after, F.lit(1))).alias("n_readings_post"),
            F.avg(F.when(after, value)).alias("_mean"),
            F.stddev_pop(F.when(after, value)).alias("_sd"),
            F.avg(
                F.when(
                    d.between(fixed.TWO_HOUR_LO_MIN * unit, fixed.TWO_HOUR_HI_MIN * unit), value
                )
            ).alias("glucose_2h"),
        ],
        having=F.col("n_readings_post") >= fixed.MIN_POST_READINGS,
        salt=salt,
    )
    base = events.join(first, key).select(
        *events.columns,
        "glucose_preprandial",
        "glucose_preprandial_mean",
        F.coalesce("glucose_preprandial", "_first").alias("_base"),
        F.col("_top.r_value").alias("peak_value"),
        (-F.col("_top")["col2"]).alias("_peak_us"),
        F.when(F.col("_mean") > 0, F.col("_sd") / F.col("_mean") * 100).alias("cv_postprandial"),
        "glucose_2h",
        "n_readings_post",
    )
    lagged = previous_in_series(
        readings.select(user, "r_us", "r_value", "r_id"),
        [user],
        post,
        "r_us",
        ["r_value"],
        ["r_id"],
    ).drop("r_id")
    b = F.col("_base")
    rise, prev_rise = (F.greatest(F.col(c) - b, F.lit(0.0)) for c in ("r_value", "prev_r_value"))
    strip = (rise + prev_rise) / 2 * ((F.col("r_us") - F.col("prev_r_us")) / F.lit(float(unit)))
    back = (F.col("r_us") > F.col("_peak_us")) & (value <= b + fixed.RECOVERY_MARGIN)
    second = interval_agg(
        base,
        lagged,
        key,
        [user],
        0,
        post,
        [
            F.coalesce(F.sum(F.when(F.col("prev_r_us") > F.col("us"), strip)), F.lit(0.0)).alias("iauc"),
            F.min(F.when(back, F.col("r_us"))).alias("_back_us"),
        ],
        closed="right",
        keep=["_base", "_peak_us"],
        salt=salt,
    )
    return base.join(second, key, "left").select(
        *events.columns,
        "glucose_preprandial",
        "glucose_preprandial_mean",
        "peak_value",
        ((F.col("_peak_us") - F.col("us")) / F.lit(float(unit))).alias("time_to_peak_min"),
        (F.col("peak_value") - b).alias("amplitude"),
        "iauc",
        ((F.col("_back_us") - F.col("_peak_us")) / F.lit(float(unit))).alias("recovery_time_min"),
        "cv_postprandial",
        "glucose_2h",
        "n_readings_post",
    )


def skipped(events: DataFrame, readings: DataFrame, scale: int = 1, key: str = "meal_id",
            user: str = "user_id") -> DataFrame:
    """How many events have no series, too few readings, or pass."""
    unit = US_PER_MIN * scale
    counts = interval_agg(
        events,
        readings.select(user, "r_us"),
        key,
        [user],
        0,
        fixed.POST_MIN * unit,
        [F.count(F.lit(1)).alias("_n")],
        closed="right",
    )
    users = readings.select(user).distinct().withColumn("_known", F.lit(True))
    rows = events.join(users, user, "left").join(counts, key, "left")
    known = F.col("_known").isNotNull()
    n = F.coalesce("_n", F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(~known).alias("no_series"),
        F.count_if(known & (n < fixed.MIN_POST_READINGS)).alias("too_few"),
        F.count_if(n >= fixed.MIN_POST_READINGS).alias("processed"),
    )


def pre_window(events: DataFrame, readings: DataFrame, scale: int = 1, key: str = "meal_id",
               user: str = "user_id", salt: int = 1) -> DataFrame:
    """Measures of the 30, 60 and 90 minute windows before each event, in one join.

    Every event comes back; the windows are nested, so the widest is joined and
    the others are conditions.
    """
    unit = US_PER_MIN * scale
    mins = (F.col("r_us") - F.col("us")) / F.lit(float(unit))
    d = F.col("us") - F.col("r_us")
    value = F.col("r_value")
    at = F.struct("r_us", "r_id")

    def inside(minutes: int):
        return d <= minutes * unit

    aggs = []
    for m in (fixed.PRE_SHORT_MIN, fixed.PRE_LONG_MIN, fixed.PRE_FALLBACK_MIN):
        w = inside(m)
        aggs += [
            F.count(F.when(w, F.lit(1))).alias(f"_n{m}"),
            F.regr_slope(F.when(w, value), F.when(w, mins)).alias(f"_slope{m}"),
            (F.max_by(F.when(w, value), F.when(w, at)) - F.min_by(F.when(w, value), F.when(w, at))).alias(
                f"_delta{m}"
            ),
            F.stddev_pop(F.when(w, value)).alias(f"_std{m}"),
        ]
    long = inside(fixed.PRE_LONG_MIN)
    in_range = value.between(fixed.TARGET_LO, fixed.TARGET_HI)
    aggs += [
        (F.avg(F.when(long, in_range.cast("double"))) * 100).alias("_tir"),
        (F.avg(F.when(long, (value > fixed.TARGET_HI).cast("double"))) * 100).alias("_above"),
    ]
    w = interval_agg(
        events,
        readings.select(user, "r_us", "r_value", "r_id"),
        key,
        [user],
        -fixed.PRE_FALLBACK_MIN * unit,
        0,
        aggs,
        salt=salt,
    )

    def gate(name: str, minutes: int, least: int):
        return F.when(F.col(f"_n{minutes}") >= least, F.col(name))

    s60, s90 = gate("_slope60", 60, 2), gate("_slope90", 90, 3)
    d60, d90 = gate("_delta60", 60, 2), gate("_delta90", 90, 3)
    return events.join(w, key, "left").select(
        *events.columns,
        gate("_slope30", 30, 2).alias("cgm_slope_30m"),
        s60.alias("cgm_slope_60m"),
        gate("_std30", 30, 2).alias("cgm_std_30m"),
        gate("_delta30", 30, 2).alias("cgm_delta_30m"),
        d60.alias("cgm_delta_60m"),
        gate("_tir", 60, 2).alias("cgm_tir_pre"),
        gate("_above", 60, 2).alias("cgm_pct_above_target"),
        F.coalesce("_n60", F.lit(0)).alias("n_readings_pre_60m"),
        s90.alias("cgm_slope_90m"),
        d90.alias("cgm_delta_90m"),
        gate("_std90", 90, 3).alias("cgm_std_90m"),
        F.coalesce(s60, s90).alias("cgm_slope_best"),
        F.when(s60.isNotNull(), d60)
        .otherwise(F.when(F.col("_n90") >= 3, F.col("_delta90")).otherwise(d60))
        .alias("cgm_delta_best"),
        F.when(s60.isNotNull(), 60).when(F.col("_n90") >= 3, 90).alias("cgm_window_used"),
    )


def time_in_range(value: str):
    return F.avg(F.col(value).between(fixed.TARGET_LO, fixed.TARGET_HI).cast("double")) * 100
