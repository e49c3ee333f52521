"""Scalar column functions. All stay on the JVM; none is a UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from sensorloom.functions import fixed

US_PER_MIN = 60_000_000
US_PER_HOUR = 3_600_000_000
US_PER_DAY = 86_400_000_000


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time ---------------------------------------------------------------------

def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch (session zone UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def parse_timestamp(text: Column | str) -> Column:
    """Text to timestamp: ISO forms first, then the listed formats, of which the first that fits counts (so months before
    days). What cannot be read becomes null."""
    text = F.trim(_c(text))
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in fixed.TIME_FORMATS])


def bucket_start(us: Column | str, width: int) -> Column:
    """Start of the fixed-width bucket holding `us`, in exact integer arithmetic."""
    us = _c(us)
    return us - F.pmod(us, F.lit(width).cast("long"))


def elapsed(later: Column | str, earlier: Column | str, unit_us: int) -> Column:
    return (_c(later) - _c(earlier)) / F.lit(float(unit_us))


def day_of_week(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(_c(ts))


def is_weekend(ts: Column | str) -> Column:
    return (F.weekday(_c(ts)) >= 5).cast("int")


def day_period(hour: Column | str) -> Column:
    h = _c(hour)
    return (
        F.when(h < 5, "night")
        .when(h < 10, "breakfast")
        .when(h < 13, "mid_morning")
        .when(h < 16, "lunch")
        .when(h < 19, "snack")
        .when(h < 23, "dinner")
        .otherwise("night")
    )


# --- numbers --------------------------------------------------------------------

def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(_c(c)), _c(c))


def ratio(x: Column | str, y: Column | str) -> Column:
    """x / y, null where y is 0."""
    return F.try_divide(_c(x), _c(y))


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip that leaves null alone (greatest/least would skip it)."""
    c = _c(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def null_if(c: Column | str, bad: Column) -> Column:
    """Null where `bad` holds; an unknown `bad` keeps the value."""
    return F.when(bad, F.lit(None)).otherwise(_c(c))


def between(c: Column | str, lo: float, hi: float) -> Column:
    return _c(c).between(lo, hi)


def log_floor(c: Column | str) -> Column:
    return F.log1p(clip(c, 0.0))


def unlog_floor(c: Column | str) -> Column:
    return clip(F.expm1(_c(c)), 0.0)


def bound_number(text: Column | str, default: float, lo: float, hi: float) -> Column:
    """Text to number; unreadable or missing takes the default, then clip."""
    return clip(F.coalesce(_c(text).try_cast("double"), F.lit(default)), lo, hi)


def flag01(c: Column | str) -> Column:
    """0/1 number clipped to that range, missing counts as 0."""
    return clip(F.coalesce(_c(c).try_cast("double"), F.lit(0.0)), 0.0, 1.0)


def is_flag(c: Column | str) -> Column:
    """True for any spelling of a set flag."""
    return F.lower(F.trim(_c(c).cast("string"))).isin(*fixed.FLAG_WORDS)


# --- text -----------------------------------------------------------------------

def title_case(text: Column | str) -> Column:
    """Trim, then a capital after every non-letter.

    initcap only looks at blanks, so a blank is put behind each non-letter and
    taken out again with the marker that tells it from a real one.
    """
    marked = F.regexp_replace(F.trim(_c(text)), r"([^\p{L}])", "$1\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def map_values(c: Column | str, table: Mapping[str, str]) -> Column:
    """Lookup in a fixed dictionary; null where the key is absent."""
    pairs: list[Column] = []
    for key, value in table.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def activity_name(c: Column | str) -> Column:
    table = {a: name for name, aliases in fixed.ACTIVITY_ALIASES.items() for a in aliases}
    return F.coalesce(map_values(c, table), _c(c))


def activity_intensity(name: Column | str) -> Column:
    table = {n: level for level, names in fixed.ACTIVITY_INTENSITY.items() for n in names}
    return F.coalesce(map_values(name, table), F.lit(fixed.INTENSITY_DEFAULT))


def intensity_score(level: Column | str) -> Column:
    out = F.lit(0.0)
    for name, score in fixed.INTENSITY_SCORE.items():
        out = F.when(_c(level) == name, F.lit(score)).otherwise(out)
    return out


# --- meal arithmetic --------------------------------------------------------------

def energy_share(grams: Column | str, kcal_per_gram: float, calories: Column | str) -> Column:
    """Share of the energy in percent, null for no energy."""
    return ratio(_c(grams) * F.lit(float(kcal_per_gram)), calories) * 100


def net_carbs(carbs: Column | str, fibre: Column | str, clipped: bool = True) -> Column:
    net = _c(carbs) - F.coalesce(_c(fibre), F.lit(0.0))
    return clip(net, 0.0) if clipped else net


def effective_gi(n_high_gi: Column | str, pct_cal_fat: Column | str) -> Column:
    share = clip(F.coalesce(_c(pct_cal_fat), F.lit(0.0)) / 100, 0.0, 1.0)
    return _c(n_high_gi) * (1 - share)


def gi_fibre(n_high_gi: Column | str, fibre_carb_ratio: Column | str) -> Column:
    return _c(n_high_gi) * (1 - clip(F.coalesce(_c(fibre_carb_ratio), F.lit(0.0)), 0.0, 1.0))


# --- classes and labels -----------------------------------------------------------

def time_class(minutes: Column | str) -> Column:
    m = _c(minutes)
    return (
        F.when(m < fixed.FAST_BELOW, 0)
        .when(m <= fixed.LATE_ABOVE, 1)
        .when(m > fixed.LATE_ABOVE, 2)
    )


def is_extreme_time(minutes: Column | str) -> Column:
    return (_c(minutes) < fixed.FAST_BELOW) | (_c(minutes) > fixed.LATE_ABOVE)


def late_label(minutes: Column | str) -> Column:
    return (_c(minutes) > fixed.LATE_ABOVE).cast("int")


def response_band(peak: Column | str) -> Column:
    out = F
    for upper, name in fixed.RESPONSE_BANDS:
        out = out.when(_c(peak) < upper, name)
    return F.when(_c(peak).isNotNull(), out.otherwise(fixed.RESPONSE_BAND_ELSE))


def baseline_band(level: Column | str) -> Column:
    v = _c(level)
    return F.when(v < 70, "low").when(v <= 100, "optimal").when(v <= 140, "raised").when(v > 140, "high")


def ttp_label(
    p: Column | str, lo: float = 0.35, hi: float = 0.65, closed: bool = False, cut: float = 0.5
) -> Column:
    """late / fast / uncertain. `closed` puts both edges into the uncertain band."""
    p = _c(p)
    unsure = (p >= lo) & (p <= hi) if closed else (p > lo) & (p < hi)
    return F.when(unsure, "uncertain").when(p > cut if not closed else p >= cut, "late").when(
        p.isNotNull(), "fast"
    )


def ttp_minutes(p: Column | str, lo: float = 0.35, hi: float = 0.65) -> Column:
    p = _c(p)
    return (
        F.when(p > hi, fixed.TTP_MINUTES["late"])
        .when(p < lo, fixed.TTP_MINUTES["fast"])
        .when(p.isNotNull(), fixed.TTP_MINUTES["uncertain"])
    )


def advice(peak: Column | str, label: Column | str, carbs: Column | str, fibre: Column | str) -> Column:
    """Codes of the advice lines that apply, in order."""
    peak, label, carbs, fibre = _c(peak), _c(label), _c(carbs), _c(fibre)
    level = F.when(peak > 160, "high_peak").when(peak > 140, "raised_peak").otherwise("in_range")
    timing = F.when(label == "late", "late_activity").when(label == "fast", "no_hard_exercise")
    fibre_ratio = fibre / F.greatest(carbs, F.lit(1.0))
    more_fibre = F.when((fibre_ratio < 0.15) & (carbs > 40), "add_fibre")
    return F.filter(F.array(level, timing, more_fibre), lambda x: x.isNotNull())


def sample_weight(user_error: Column | str, all_error: Column | str) -> Column:
    w = clip(ratio(user_error, all_error), fixed.WEIGHT_LO, fixed.WEIGHT_HI)
    return F.coalesce(w, F.lit(1.0))


def value_range(c: Column | str) -> Column:
    out = F
    for lo, hi, label in fixed.BIAS_RANGES:
        out = out.when((_c(c) >= lo) & (_c(c) < hi), label)
    return out.otherwise(F.lit(None))


# --- arrays -----------------------------------------------------------------------

def normalise(values: Column | str, mean: float = 0.5, sd: float = 0.5) -> Column:
    return F.transform(_c(values), lambda x: (x.cast("double") - mean) / sd)


# --- choices ----------------------------------------------------------------------


def existing(columns: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """Wanted columns that are there, in wanted order."""
    return [c for c in wanted if c in columns]
