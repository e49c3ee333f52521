"""Cleaning rules and their audit log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sensorloom.functions import columns as C
from sensorloom.functions import fixed


@dataclass(frozen=True)
class Rule:
    """A named condition whose hits are counted."""

    action: str
    hit: Column
    reason: str
    always: bool = True  # log it even without a hit


# What a rule does with a hit, and why there is the rule.
DROP_ROW, DROP_VALUE, NOTE = "row goes", "value becomes null", "noted"
REASONS = {
    "range": "outside the values kept",
    "sign": "amounts begin at 0",
    "zero": "0 stands for no answer",
    "day": "before the first day kept, or no time",
    "time": "texts of all known forms are read",
    "name": "one name for all its aliases",
    "item": "no item has this key",
}


def said(column: str, test: str, effect: str) -> str:
    """Name of a rule, from its column, its test and its effect."""
    return f"{column} {test}: {effect}"


def _counts(rules: Sequence[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_total"), *[F.count_if(r.hit).alias(f"_r{i}") for i, r in enumerate(rules)]]


def audit(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One pass over the table, one log row per rule."""
    return _log(df.agg(*_counts(rules)), table, rules)


class Watch:
    """Counts of a table's rules, taken while something else reads it: no pass of their own."""

    def __init__(self, table: str, rules: Sequence[Rule] = ()):
        self.table, self.rules, self.seen = table, list(rules), Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """`df`, to be written or read once as a whole."""
        return df.observe(self.seen, *_counts(self.rules))

    @property
    def rows(self) -> int:
        """Waits for the first job over the watched frame."""
        return self.seen.get["n_total"]

    def log(self, spark: SparkSession) -> DataFrame:
        found = self.seen.get
        names = ["n_total", *[f"_r{i}" for i in range(len(self.rules))]]
        counts = spark.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"{n} long" for n in names))
        return _log(counts, self.table, self.rules)


def _log(counts: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(r.action).alias("action"),
                F.col(f"_r{i}").alias("n_affected"),
                F.lit(r.reason).alias("justification"),
                F.lit(r.always).alias("always"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return (
        counts.select("n_total", F.explode(rows).alias("_s"))
        .where(F.col("_s.always") | (F.col("_s.n_affected") > 0))
        .select(
            F.lit(table).alias("table"),
            F.col("_s.action").alias("action"),
            F.col("_s.n_affected").alias("n_affected"),
            "n_total",
            F.round(
                F.coalesce(F.try_divide(F.col("_s.n_affected"), F.col("n_total")), F.lit(0.0)) * 100, 3
            ).alias("pct_affected"),
            F.col("_s.justification").alias("justification"),
        )
    )


def parse_times(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumn(column, C.parse_timestamp(column))


def parse_rules(column: str = "timestamp") -> list[Rule]:
    """Rules to run on the raw text column."""
    ok = C.parse_timestamp(column).isNotNull()
    return [
        Rule(said("time", "read", NOTE), ok, REASONS["time"]),
        Rule(said("time", "not read", DROP_VALUE), ~ok, REASONS["time"], always=False),
    ]


def keep_range(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    return df.where(F.col(column).between(lo, hi))


def keep_since(df: DataFrame, ts: str, date: str = fixed.SINCE_DATE) -> DataFrame:
    """Rows from the date on; rows without a time go as well."""
    return df.where(F.col(ts) >= F.lit(date).cast(df.schema[ts].dataType))


# --- readings -------------------------------------------------------------------

def clean_readings(raw: DataFrame, value: str = "value_decimal", ts: str = "timestamp") -> DataFrame:
    named = raw.withColumnRenamed("id", "user_id") if "user_id" not in raw.columns else raw
    return keep_since(keep_range(named, value, fixed.VALUE_LO, fixed.VALUE_HI), ts)


def reading_rules(raw: DataFrame, value: str = "value_decimal", ts: str = "timestamp") -> list[Rule]:
    v = F.col(value)
    start = F.lit(fixed.SINCE_DATE).cast(raw.schema[ts].dataType)
    old = v.between(fixed.VALUE_LO, fixed.VALUE_HI) & ((F.col(ts) < start) | F.col(ts).isNull())
    return [
        Rule(said("reading", f"< {fixed.VALUE_LO:g}", DROP_ROW), v < fixed.VALUE_LO, REASONS["range"]),
        Rule(said("reading", f"> {fixed.VALUE_HI:g}", DROP_ROW), v > fixed.VALUE_HI, REASONS["range"]),
        Rule(said("time", "too early or missing", DROP_ROW), old, REASONS["day"], always=False),
    ]


# --- meal items -------------------------------------------------------------------

def clean_items(raw: DataFrame) -> DataFrame:
    """Negative and impossible amounts become null, in one projection."""
    out = {}
    for c in dict.fromkeys([*fixed.ITEM_NON_NEGATIVE, *fixed.ITEM_LIMITS]):
        bad = F.col(c) > fixed.ITEM_LIMITS[c] if c in fixed.ITEM_LIMITS else F.lit(False)
        if c in fixed.ITEM_NON_NEGATIVE:
            bad = bad | (F.col(c) < 0)
        out[c] = C.null_if(c, bad)
    return raw.withColumns(out)


def item_rules() -> list[Rule]:
    rules = [
        Rule(said(c, "< 0", DROP_VALUE), F.col(c) < 0, REASONS["sign"], always=False)
        for c in fixed.ITEM_NON_NEGATIVE
    ]
    rules += [
        Rule(said(c, f"> {limit:g}", DROP_VALUE), F.col(c) > limit, REASONS["range"], always=False)
        for c, limit in fixed.ITEM_LIMITS.items()
    ]
    return rules


# --- meals ------------------------------------------------------------------------

def flag_exists(df: DataFrame, other: DataFrame, key: str, other_key: str, flag: str = "has_items") -> DataFrame:
    """Flag rows whose key occurs in the other table."""
    keys = other.select(F.col(other_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(keys.withColumn("_hit", F.lit(True)), key, "left").select(
        *df.columns, F.col("_hit").isNotNull().alias(flag)
    )


def flag_rules(flag: str = "has_items") -> list[Rule]:
    return [Rule(said("meal", "without items", NOTE), ~F.col(flag), REASONS["item"])]


# --- activity ---------------------------------------------------------------------

def clean_activity(raw: DataFrame, ts: str = "timestamp", type_col: str = "type") -> DataFrame:
    kept = keep_since(raw, ts)
    duration = F.nullif("duration", F.lit(0.0))
    named = kept.withColumns(
        {
            "duration": C.null_if(duration, duration > fixed.ACTIVITY_LIMIT),
            "type_original": F.col(type_col),
            "type_normalized": C.activity_name(type_col),
        }
    )
    return named.withColumn("intensity_category", C.activity_intensity("type_normalized"))


def activity_rules(raw: DataFrame, ts: str = "timestamp", type_col: str = "type") -> list[Rule]:
    d = F.col("duration")
    start = F.lit(fixed.SINCE_DATE).cast(raw.schema[ts].dataType)
    old = (F.col(ts) < start) | F.col(ts).isNull()
    return [
        Rule(said("duration", "= 0", DROP_VALUE), d == 0, REASONS["zero"]),
        Rule(said("duration", f"> {fixed.ACTIVITY_LIMIT:g}", DROP_VALUE), d > fixed.ACTIVITY_LIMIT, REASONS["range"]),
        Rule(said("time", "too early or missing", DROP_ROW), old, REASONS["day"], always=False),
        Rule(said("type", "given its common name", NOTE), ~old & F.col(type_col).isNotNull(), REASONS["name"]),
    ]


# --- morning questionnaire ----------------------------------------------------------

def two_sided(column: str, lo: float, hi: float) -> Column:
    """0 < v < lo or v > hi; negative values are left alone, as published."""
    c = F.col(column)
    return ((c > 0) & (c < lo)) | (c > hi)


def clean_morning(raw: DataFrame) -> DataFrame:
    """Answers outside their limits become null; where there is a lower limit, 0 does as well."""
    tidy = {c: C.null_if(c, two_sided(c, lo, hi) | (F.col(c) == 0)) for c, (lo, hi) in fixed.MORNING_BANDS.items()}
    return raw.withColumns(tidy | {c: C.null_if(c, F.col(c) > hi) for c, hi in fixed.MORNING_LIMITS.items()})


def morning_rules() -> list[Rule]:
    rules = []
    for c, (lo, hi) in fixed.MORNING_BANDS.items():
        rules.append(Rule(said(c, "= 0", DROP_VALUE), F.col(c) == 0, REASONS["zero"]))
        rules.append(Rule(said(c, f"not in {lo:g} to {hi:g}", DROP_VALUE), two_sided(c, lo, hi), REASONS["range"]))
    for c, hi in fixed.MORNING_LIMITS.items():
        rules.append(Rule(said(c, f"> {hi:g}", DROP_VALUE), F.col(c) > hi, REASONS["range"]))
    return rules


# --- users --------------------------------------------------------------------------

def user_counts(base: DataFrame, others: dict[str, DataFrame], name: str) -> DataFrame:
    """Rows per user of `base`, and of each other table (0 where absent)."""
    out = base.groupBy("user_id").agg(F.count(F.lit(1)).alias(name))
    for column, df in others.items():
        n = df.groupBy("user_id").agg(F.count(F.lit(1)).alias(column))
        out = out.join(n, "user_id", "left").withColumn(column, F.coalesce(column, F.lit(0)))
    return out


def user_quality(readings: DataFrame, meals: DataFrame, sport: DataFrame, morning: DataFrame,
                 night: DataFrame, limits: dict[str, int] = fixed.QUALITY_MIN) -> DataFrame:
    counts = user_counts(
        readings,
        {
            "n_meals": meals.where("has_items"),
            "n_sport_sessions": sport,
            "n_quest_morning": morning,
            "n_quest_night": night,
        },
        "n_glucose_readings",
    )
    q = limits["questionnaire"]
    flagged = counts.withColumns(
        {
            "has_glucose": F.col("n_glucose_readings") >= limits["readings"],
            "has_meals": F.col("n_meals") >= limits["meals"],
            "has_sport": F.col("n_sport_sessions") >= limits["sport"],
            "has_questionnaires": (F.col("n_quest_morning") >= q) | (F.col("n_quest_night") >= q),
        }
    )
    flags = ("has_glucose", "has_meals", "has_sport", "has_questionnaires")
    score = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    return flagged.withColumns(
        {
            "completeness_score": score,
            "viable_glycemic_model": F.col("has_glucose") & F.col("has_meals"),
        }
    )


def before_after(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of each table before and after cleaning."""
    out = None
    for name, (before, after) in pairs.items():
        rows = (
            before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
            .unionByName(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
            .agg(
                F.coalesce(F.sum("b"), F.lit(0)).alias("n_before"),
                F.coalesce(F.sum("a"), F.lit(0)).alias("n_after"),
            )
            .select(
                F.lit(name).alias("table"), "n_before", "n_after",
                (F.col("n_after") - F.col("n_before")).alias("delta"),
            )
        )
        out = rows if out is None else out.unionByName(rows)
    return out
