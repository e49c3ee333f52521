"""Context, nutrition, cleaning, text and medians on hand-made tables."""

import math

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import columns as C
from sensorloom.functions.curve import curve_points
from sensorloom.operators import clean, context, folds, metrics, nutrition, profiles, ranks
from sensorloom.operators.response import pre_window
from tests.conftest import MIN

HOUR = 60


def row(df):
    return df.collect()[0]


def sport(spark, at, rows):
    return spark.createDataFrame(
        [(u, at(t), d, i) for u, t, d, i in rows], "user_id long, r_us long, duration double, intensity_category string"
    )


def test_activity_edges(spark, at, make_meals):
    s = sport(spark, at, [(1, -24 * HOUR, 30.0, "low"), (1, 0, 99.0, "high"), (1, -48 * HOUR, 10.0, "high")])
    r = row(context.prior_activity(make_meals([(1, 1, 0)]), s))
    assert (r.sport_prior_duration, r.sport_prior_sessions, r.sport_prior_intensity) == (30, 1, "low")
    assert r.hours_since_last_sport == 24
    assert (r.sport_48h_duration, r.sport_48h_sessions) == (40, 2)
    assert r.sport_intensity_score == pytest.approx((1 * 30 + 3 * 10) / 40)


def test_activity_without_durations_or_sessions(spark, at, make_meals):
    s = sport(spark, at, [(1, -60, None, "high"), (1, -50, None, "other")])
    got = {r.meal_id: r for r in context.prior_activity(make_meals([(1, 1, 0), (2, 2, 0)]), s).collect()}
    assert got[1].sport_intensity_score == 1.5
    assert got[1].sport_prior_duration == 0 and got[1].sport_prior_intensity == "high"
    assert (got[2].sport_prior_sessions, got[2].sport_prior_intensity, got[2].hours_since_last_sport) == (0, "none", None)
    # an unknown level counts as low in the day's bundle
    only = sport(spark, at, [(1, -60, 5.0, "other")])
    assert row(context.prior_activity(make_meals([(1, 1, 0)]), only)).sport_prior_intensity == "low"


def test_two_answers_first_wins_and_lag(spark, moment):
    meals = spark.createDataFrame([(1, 1, moment(0)), (2, 1, moment(24 * HOUR)), (3, 2, moment(0))],
                                  "meal_id long, user_id long, ts timestamp_ntz")
    answers = spark.createDataFrame(
        [(7, 1, moment(-60), 400.0, True), (6, 1, moment(-30), 500.0, False)],
        "id long, user_id long, ts timestamp_ntz, sleep double, sick boolean",
    )
    same = context.daily_answers(meals, answers, {"sleep": "s"}, ("sick", "is_sick"))
    assert {r.meal_id: (r.s, r.is_sick) for r in same.collect()} == {1: (400, True), 2: (None, False), 3: (None, False)}
    lag = context.daily_answers(meals, answers, {"sleep": "s"}, ("sick", "is_sick"), 1)
    assert {r.meal_id: r.s for r in lag.collect()} == {1: None, 2: 400, 3: None}


def test_rolling_is_strict_and_safe_waits(spark, at):
    rows = [(1, 1, 0, 100.0), (2, 1, 60, 120.0), (3, 1, 120, 140.0), (4, 1, 120, 999.0), (5, 1, 300, 50.0)]
    meals = spark.createDataFrame([(m, u, at(t), p, 10.0) for m, u, t, p in rows],
                                  "meal_id long, user_id long, us long, peak_value double, time_to_peak_min double")
    none = spark.createDataFrame([], "user_id long, r_us long, r_value double")
    got = {r.meal_id: r for r in context.rolling_user(meals, none).collect()}
    assert got[3].user_peak_mean_roll is None and got[4].user_peak_mean_roll is None
    assert got[5].user_peak_mean_roll == pytest.approx((100 + 120 + 140 + 999) / 4)
    safe = {r.meal_id: r for r in context.rolling_user(meals, none, safe=True).collect()}
    assert safe[5].user_peak_mean_roll == pytest.approx((100 + 120 + 140 + 999) / 4)
    later = spark.createDataFrame([(m, u, at(t), p, 10.0) for m, u, t, p in rows[:4] + [(5, 1, 299, 50.0)]], meals.schema)
    safe = {r.meal_id: r for r in context.rolling_user(later, none, safe=True).collect()}
    assert safe[5].user_peak_mean_roll is None  # only two meals have passed their window


def test_no_later_row_changes_earlier_features(spark, at):
    rows = [(i, 1, i * 60, 100.0 + i) for i in range(12)]
    schema = "meal_id long, user_id long, us long, peak_value double, time_to_peak_min double"
    frame = lambda rs: spark.createDataFrame([(m, u, at(t), p, 5.0) for m, u, t, p in rs], schema)
    readings = spark.createDataFrame([(1, at(t), float(t)) for t in range(0, 720, 5)], "user_id long, r_us long, r_value double")
    cut = at(360)
    whole = {r.meal_id: r.asDict() for r in context.rolling_user(frame(rows), readings, safe=True).collect()}
    part = context.rolling_user(frame(rows[:7]), readings.where(F.col("r_us") <= cut), safe=True).collect()
    for r in part:
        assert r.asDict() == pytest.approx(whole[r.meal_id])


def test_same_day(spark, at, moment):
    rows = [(1, 0, 10.0, 150.0), (2, 60, 20.0, 140.0), (3, 60, 5.0, 130.0), (4, 13 * 60, 1.0, 100.0)]
    df = spark.createDataFrame([(m, 1, moment(t), at(t), c, p) for m, t, c, p in rows],
                               "meal_id long, user_id long, ts timestamp_ntz, us long, total_carbs double, peak_value double")
    got = {r.meal_id: r for r in context.same_day(df).collect()}
    assert (got[1].prev_meals_today, got[1].prev_peak_today_max, got[1].carbs_load_today) == (0, None, 0)
    assert got[2].prev_meals_today == got[3].prev_meals_today == 1
    assert got[3].hours_since_last_meal == 1
    assert got[4].prev_meals_today == 0  # the next UTC day


def test_pre_window_gates_and_fallback(make_meals, make_readings):
    meals = make_meals([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0)])
    readings = make_readings(
        [(1, -60, 100), (1, -30, 130), (1, 0, 160)]  # edges of both windows
        + [(2, -90, 90), (2, -80, 100), (2, -10, 110)]  # only one in the last hour
        + [(3, -5, 100), (3, -5, 120)]  # same instant
    )
    got = {r.meal_id: r for r in pre_window(meals, readings).collect()}
    assert got[1].cgm_slope_60m == pytest.approx(1.0) and got[1].cgm_delta_60m == 60
    assert got[1].cgm_slope_30m == pytest.approx(1.0) and got[1].cgm_std_30m == 15
    assert got[1].cgm_tir_pre == pytest.approx(200 / 3) and got[1].cgm_window_used == 60
    assert got[2].cgm_slope_60m is None and got[2].cgm_window_used == 90
    assert got[2].cgm_slope_best == pytest.approx(got[2].cgm_slope_90m) and got[2].cgm_delta_best == 20
    assert got[3].cgm_slope_30m is None
    assert got[4].n_readings_pre_60m == 0 and got[4].cgm_window_used is None


def items(spark, rows):
    return spark.createDataFrame(
        rows, "id long, meal_id long, food_id long, amount double, calories double, protein double, fat double, carbs double"
    )


FOODS = ("food_id long, fibre_gram_value double, atri_ultraprocessed string, atri_high_glycemic_index string,"
         " atri_sugar_add boolean, saturated_fatty_acid double, food_group_id long, row_id long")


def test_nutrition_of_empty_and_unknown_items(spark):
    it = items(spark, [(1, 1, 10, 100.0, None, None, None, None), (2, 2, 99, 50.0, 80.0, 1.0, 2.0, 3.0),
                       (3, 2, 10, 200.0, 20.0, 4.0, 5.0, 0.0)])
    foods = spark.createDataFrame([(10, 5.0, "Si", "No", True, 2.0, 1, 2), (10, 50.0, "No", "No", False, 9.0, 1, 3)], FOODS)
    got = {r.meal_id: r for r in nutrition.meal_nutrition(it, nutrition.unique_foods(foods)).collect()}
    a, b = got[1], got[2]
    assert (a.total_calories, a.total_protein, a.has_nan_calories, a.has_nan_macros) == (0, 0, True, True)
    assert a.pct_cal_carbs is None and a.fibre_carb_ratio is None
    assert (a.n_ultraprocessed, a.n_sugar_added, a.total_fibre) == (1, 1, 5)
    assert (b.n_items, b.total_fibre, b.pct_items_with_fibre, b.fibre_available) == (2, 10, 0.5, True)
    assert b.avg_saturated_fat == 2 and b.n_food_groups == 1
    assert b.pct_cal_fat == pytest.approx(7 * 9 / 100 * 100)


def test_item_cleaning(spark):
    it = items(spark, [(1, 1, 1, 2001.0, -1.0, 151.0, 200.0, None), (2, 1, 1, 2000.0, 3000.0, 150.0, 201.0, 500.5)])
    a, b = clean.clean_items(it).orderBy("id").collect()
    assert (a.amount, a.calories, a.protein, a.fat, a.carbs) == (None, None, None, 200, None)
    assert (b.amount, b.calories, b.protein, b.fat, b.carbs) == (2000, 3000, 150, None, None)
    log = {r.action: r.n_affected for r in clean.audit(it, "meal_item", clean.item_rules()).collect()}
    assert log == {"calories < 0: value becomes null": 1, "protein > 150: value becomes null": 1, "fat > 200: value becomes null": 1,
                   "carbs > 500: value becomes null": 1, "amount > 2000: value becomes null": 1}


def test_bad_time_texts(spark):
    df = spark.createDataFrame(
        [("2022-05-04 12:00:00+00",), ("2022-05-04T12:00:00Z",), ("2022-05-04 14:00:00+02:00",), ("garbage",), ("",), (None,)],
        "timestamp string",
    )
    got = [C_ts(r) for r in clean.parse_times(df).select(C.micros("timestamp").alias("us")).collect()]
    assert got[0] == got[1] == got[2] is not None and got[3:] == [None] * 3
    log = {r.action: r.n_affected for r in clean.audit(df, "t", clean.parse_rules()).collect()}
    assert log == {"time read: noted": 3, "time not read: value becomes null": 3}


def C_ts(r):
    return r.us


def test_two_sided_leaves_negatives(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (29.0,), (30.0,), (120.0,), (121.0,), (None,)], "resting_hr double").selectExpr(
        "resting_hr", "resting_hr as glucose_basal", "resting_hr as sleep_time", "resting_hr as hr_variability")
    assert [r.resting_hr for r in clean.clean_morning(df).collect()] == [-5, None, None, 30, 120, None, None]


def test_clip_and_ratio_keep_null(spark):
    df = spark.createDataFrame([(None, 1.0), (-3.0, 0.0), (9.0, 3.0)], "a double, b double")
    got = df.select(C.clip("a", 0, 5).alias("c"), C.ratio("a", "b").alias("r")).collect()
    assert [(r.c, r.r) for r in got] == [(None, None), (0, None), (5, 3)]


@pytest.mark.parametrize("text", ["  COCA-COLA zero ", "o'neil élan", "pan  de3molde", "ÑAME/aceite"])
def test_title_case_is_that_of_python(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert row(df.select(C.title_case("t").alias("t"))).t == text.strip().title()


def test_label_rules_at_their_edges(spark):
    df = spark.createDataFrame([(0.35,), (0.5,), (0.65,), (0.34,), (0.66,)], "p double")
    got = df.select(C.ttp_label("p").alias("o"), C.ttp_label("p", closed=True, cut=0.4).alias("c"), C.ttp_minutes("p").alias("m"))
    assert [(r.o, r.c, r.m) for r in got.collect()] == [
        ("fast", "uncertain", 60), ("uncertain", "uncertain", 60), ("late", "uncertain", 60), ("fast", "fast", 35), ("late", "late", 90)]


def test_span_of_days(spark, at):
    cols = ("total_calories total_protein total_fat total_carbs total_fibre pct_cal_carbs pct_cal_protein pct_cal_fat"
            " fibre_carb_ratio n_ultraprocessed n_food_groups n_items").split()
    df = spark.createDataFrame([(1, 1, at(11 * 60 + 50)), (2, 1, at(12 * 60 + 10))], "meal_id long, user_id long, us long")
    p = row(profiles.nutrition_profile(df.withColumns({c: F.lit(3.0) for c in cols})))
    assert p.n_days == 1 and p.est_daily_calories == 6  # ten minutes to and past midnight are one day


def test_impute_chain(spark):
    rows = [(1, 1, None), (2, 1, None), (3, 2, 10.0), (4, 2, None), (5, 3, 1.0), (6, 3, 3.0)]
    df = spark.createDataFrame(rows, "meal_id long, user_id long, x double")
    got = {r.meal_id: r.x for r in folds.impute_user_median(df, ["x"]).collect()}
    # filled by user first: 10, 10, 1, 3 -> median 6.5
    assert got == {1: 6.5, 2: 6.5, 3: 10, 4: 10, 5: 1, 6: 3}
    empty = df.withColumn("x", F.lit(None).cast("double"))
    assert {r.x for r in folds.impute_user_median(empty, ["x"]).collect()} == {0.0}


@pytest.mark.parametrize("settings", [{}, {"sketch": 16}, {"sketch": 16, "slack": 0.0}, {"sketch": 16, "slack": 0.2, "most": 9}])
def test_exact_quantiles(spark, settings):
    """From the sketch alone, from brackets, from brackets that miss, from brackets cut into bins."""
    import numpy as np

    rng = np.random.default_rng(1)
    # one group holds most rows, with an outlier that squeezes all others into few bins
    a = np.concatenate([rng.normal(0, 1, 700), [1e9], np.full(300, 0.25)])
    b = rng.integers(0, 5, 80).astype(float)
    df = spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("b", None)], "g string, v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.q): r.value for r in ranks.exact_quantiles(df, ["v"], qs, ["g"], **settings).collect()}
    for g, x in (("a", a), ("b", b)):
        for q in qs:
            assert got[g, q] == pytest.approx(np.quantile(x, q), rel=1e-12)
    whole = ranks.exact_quantiles(df.withColumn("w", F.lit(None).cast("double")), ["v", "w"], qs, **settings)
    assert {(r.feature, r.q): pytest.approx(r.value, rel=1e-12) for r in whole.collect()} == {("v", q): np.quantile(np.concatenate([a, b]), q) for q in qs}


def test_hash_rank_is_a_row_number(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"))
    got = ranks.hash_rank(df, ["id"], 1, ["g"])
    direct = spark.sql("select 1").sparkSession  # same session
    df.createOrReplaceTempView("rows_to_rank")
    want = direct.sql("select id, row_number() over (partition by g order by md5(concat_ws(':', '1', id)), id) r,"
                      " count(*) over (partition by g) n from rows_to_rank")
    assert sorted((r.id, r["rank"], r.total) for r in got.collect()) == sorted((r.id, r.r, r.n) for r in want.collect())


def test_group_folds(spark):
    sizes = {1: 9, 2: 7, 3: 6, 4: 5, 5: 5, 6: 4}
    sizes[None] = 3
    df = spark.createDataFrame([(u, i) for u, n in sizes.items() for i in range(n)], "user_id long, i long")
    out = folds.group_folds(df, 2)
    assert out.groupBy("user_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    loads = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert sum(loads) == 39 and loads[1] - loads[0] <= 9


def test_hash_rank_keeps_rows_without_a_group(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id long, g string")
    got = sorted((r.id, r.total) for r in ranks.hash_rank(df, ["id"], 1, ["g"], "rank", "total").collect())
    assert got == [(1, 1), (2, 2), (3, 2)]


def test_zscore_without_spread(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = folds.zscore(df, ["a", "b"]).collect()
    assert [r.b_z for r in got] == [0, 0, 0]
    assert sum(r.a_z for r in got) == pytest.approx(0) and math.isclose(sum(r.a_z**2 for r in got), 3)


def test_bias_bins_of_few_rows_are_left_out(spark):
    df = spark.createDataFrame([(150.0, 140.0)] * 5 + [(250.0, 100.0)] * 4, "y double, p double")
    got = metrics.bias_by_range(df, "y", {"m": "p"}).collect()
    assert [(r["range"], r.n, r.bias_m, r.mae_m) for r in got] == [("140-160", 5, -10, 10)]


def test_macro_f1_leaves_absent_class_out(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "y int, p int")
    r = row(metrics.macro_by(df, [], "y", "p", [0, 1, 2]))
    assert r.f1_macro == pytest.approx((2 / 3 + 2 / 3) / 2)


def test_curve_ends(spark):
    df = spark.createDataFrame([(100.0, 160.0, 60)], "b double, p double, m int")
    points = sorted(curve_points(df, "b", "p", "m").collect(), key=lambda r: r.minute)
    assert len(points) == 30 + 59 + 119
    assert points[0].minute == -30 and points[29].minute == 0 and points[29].value == 100
    assert points[88].minute == pytest.approx(60) and points[88].value == pytest.approx(160)
    assert points[-1].minute == pytest.approx(180) and points[-1].value == pytest.approx(106)  # a tenth of the rise is left


def test_meal_totals_skip_unknown_and_empty(spark):
    foods = spark.createDataFrame(
        [("Pan", 50.0, 2.0, 8.0, 4.0, 1.0, 0.0, 1.0), ("Pollo", 0.0, 10.0, 25.0, 0.0, 0.0, 1.0, 3.0)],
        "food_esp_name string, carbs_100g double, fat_100g double, protein_100g double, fibre_100g double, high_gi double,"
        " ultraprocessed double, saturated_fat_100g double",
    )
    chosen = spark.createDataFrame([(1, "Pan", 60.0), (1, "Pollo", 200.0), (1, "Nada", 90.0), (1, "Pan", 0.0), (2, "Nada", 5.0)],
                                   "meal_id long, food_esp_name string, grams double")
    got = {r.meal_id: r for r in nutrition.meal_totals(chosen, foods).collect()}
    assert (got[1].carbs, got[1].fat, got[1].n_items, got[1].n_high_gi, got[1].n_ultraprocessed) == (30, 21.2, 2, 1, 1)
    assert got[1].avg_sat_fat == pytest.approx((0.6 + 6) / 2)
    assert (got[2].carbs, got[2].n_items) == (0, 0)
    unscaled = {r.meal_id: r for r in nutrition.meal_totals(chosen, foods, scaled_fat=False).collect()}
    assert unscaled[1].avg_sat_fat == 2


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("z",)], "c string")
    assert {r.c: r.code for r in ranks.label_codes(df, "c", "code").collect()} == {"a": 0, "b": 1, None: 2, "z": 3}


def test_window_scale_moves_the_edges(make_meals, make_readings):
    got = pre_window(make_meals([(1, 1, 0)]), make_readings([(1, -60 * 60, 1), (1, -60, 3)]), scale=60).collect()[0]
    assert got.n_readings_pre_60m == 2 and got.cgm_slope_60m == pytest.approx(2 / 59)
    assert MIN == 60_000_000


def test_label_codes_over_many_partitions(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("l"), F.col("id") % 700)).alias("label"), "id").repartition(9)
    got = {(r.label or "unknown"): r.code for r in ranks.label_codes(df, "label", "code").collect()}
    assert got == {label: i for i, label in enumerate(sorted(got))} and len(got) == 601
    assert ranks.label_codes(df.limit(0), "label", "code").count() == 0
