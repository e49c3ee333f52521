"""Expected course of a response: flat before, a rise to the peak, a decay after."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

PRE_POINTS = 30
MIN_RISE_POINTS = 20
RISE_CENTRE = 0.45
RISE_STEEPNESS = 8.0
LN_TEN = math.log(10)  # a tenth of the rise is left at the end


def curve_points(df: DataFrame, base: str, peak: str, minutes: str, pre_min: int = 30,
                 recovery_min: int = 120) -> DataFrame:
    """One row per point: the columns of `df`, `minute` and `value`.

    The number of points depends on the minutes to the peak and the fixed lengths
    only, so the table grows by a bounded factor. Point numbers are exploded and
    the rest is plain arithmetic on each row.
    """
    b, p = F.col(base).cast("double"), F.col(peak).cast("double")
    span = F.col(minutes).cast("double")
    n = F.greatest(F.col(minutes).cast("int"), F.lit(MIN_RISE_POINTS))
    points = PRE_POINTS + (n - 1) + (recovery_min - 1)
    rows = df.withColumn("_i", F.explode(F.sequence(F.lit(0), points - 1)))
    i = F.col("_i")

    flat_minute = i / (PRE_POINTS - 1) * pre_min - pre_min

    rise_minute = span * (i - PRE_POINTS + 1) / (n - 1)
    k = RISE_STEEPNESS / F.greatest(span, F.lit(1.0))

    def sigmoid(t):
        return 1.0 / (1.0 + F.exp(-k * (t - span * RISE_CENTRE)))

    first, last = sigmoid(F.lit(0.0)), sigmoid(span)
    height = F.greatest(last - first, F.lit(1e-9))
    rise_value = b + (p - b) * ((sigmoid(rise_minute) - first) / height)

    fall_minute = (i - PRE_POINTS - (n - 1) + 1) / (recovery_min - 1) * recovery_min
    fall_value = p + (b - p) * (1.0 - F.exp(F.lit(-LN_TEN / recovery_min) * fall_minute))

    is_flat, is_rise = i < PRE_POINTS, i < PRE_POINTS + (n - 1)
    return rows.select(
        *df.columns,
        F.when(is_flat, flat_minute).when(is_rise, rise_minute).otherwise(fall_minute + span).alias("minute"),
        F.when(is_flat, b).when(is_rise, rise_value).otherwise(fall_value).alias("value"),
    )
