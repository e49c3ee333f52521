"""Boundaries, ties, carries, skew and the equality of the join forms."""

import random

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import temporal as T
from sensorloom.operators.response import response
from tests.conftest import MIN

POST = 180 * MIN


def ids(df):
    return sorted(tuple(r) for r in df.collect())


def test_edges_of_closed_and_open_windows(make_meals, make_readings):
    meals = make_meals([(1, 1, 0)])
    readings = make_readings([(1, -15, 1), (1, -15 - 1 / 60, 2), (1, 0, 3), (1, 1 / 60, 4), (1, 180, 5), (1, 180 + 1 / 60, 6)])
    pre = T.interval_join(meals, readings, ["user_id"], -15 * MIN, 0)
    post = T.interval_join(meals, readings, ["user_id"], 0, POST, "right")
    assert sorted(r.r_value for r in pre.collect()) == [1, 3]
    assert sorted(r.r_value for r in post.collect()) == [4, 5]
    day = T.interval_join(meals, readings, ["user_id"], -15 * MIN, 0, "left")
    assert sorted(r.r_value for r in day.collect()) == [1]


@pytest.mark.parametrize("closed", T.CLOSED)
@pytest.mark.parametrize("salt", [1, 3])
def test_bucketed_join_equals_plain_join(make_meals, make_readings, closed, salt):
    rng = random.Random(3)
    meals = make_meals([(i, rng.randint(1, 3), rng.randint(-500, 500)) for i in range(60)])
    # user 1 holds most rows
    readings = make_readings([(rng.choice([1, 1, 1, 2, 3]), rng.randint(-700, 700), i) for i in range(400)])
    plain = T.plain_interval_join(meals, readings, ["user_id"], -37 * MIN, 90 * MIN, closed)
    bucketed = T.interval_join(meals, readings, ["user_id"], -37 * MIN, 90 * MIN, closed, salt=salt)
    narrow = T.interval_join(meals, readings, ["user_id"], -37 * MIN, 90 * MIN, closed, width=20 * MIN)
    want = ids(plain.select("meal_id", "r_id"))
    assert want and ids(bucketed.select("meal_id", "r_id")) == want
    assert ids(narrow.select("meal_id", "r_id")) == want


def test_times_before_the_epoch(spark):
    left = spark.createDataFrame([(1, 1, -5)], "meal_id long, user_id long, us long")
    right = spark.createDataFrame([(1, -6), (1, -9), (1, 3), (1, 7)], "user_id long, r_us long")
    got = T.interval_join(left, right, ["user_id"], -3, 10)
    assert sorted(r.r_us for r in got.collect()) == [-6, 3]


def test_skewed_join_is_split_and_whole(spark, make_meals):
    """A third of all rows in one user's bucket: AQE splits the partition, nothing is lost."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from tests.conftest import US0

        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).alias("user_id"),
            (F.lit(US0) + F.when(F.col("id") % 3 == 0, F.col("id") * 1000).otherwise(F.col("id") * MIN)).alias("r_us"),
            F.rand(1).alias("r_value"), F.col("id").alias("r_id"),
        )
        meals = make_meals([(1, 1, 0), (2, 1, 0.5), (3, 7, 0)])
        got = T.interval_agg(
            meals, rows, "meal_id", ["user_id"], 0, POST, [F.count(F.lit(1)).alias("n"), F.sum("r_value").alias("v")]
        )
        counts = {r.meal_id: r.n for r in got.collect()}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert counts[1] == 20_000
        assert counts[2] == 20_000 - 10_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_as_of_takes_last_within_tolerance(make_meals, make_readings):
    meals = make_meals([(1, 1, 0), (2, 1, 16), (3, 2, 0)])
    readings = make_readings([(1, -14, 100), (1, 0, 110), (1, 1, 120)])
    got = T.as_of(meals, readings, "meal_id", ["user_id"], 15 * MIN, "r_value", "v", "r_id")
    assert {r.meal_id: r.v for r in got.collect()} == {1: 110, 2: 120, 3: None}


def test_previous_row_crosses_buckets(make_readings):
    # buckets of 180 minutes; the row before the first of a bucket comes from the one before
    times = [0, 170, 181, 185, 540, 545, 800]
    series = make_readings([(1, t, t) for t in times] + [(2, 3, 3)])
    got = T.previous_in_series(series, ["user_id"], POST, "r_us", ["r_value"], ["r_id"])
    prev = {(r.user_id, r.r_value): r.prev_r_value for r in got.collect()}
    assert prev == {(1, 0): None, (1, 170): 0, (1, 181): 170, (1, 185): 181, (1, 540): None, (1, 545): 540,
                    (1, 800): None, (2, 3): None}


@pytest.mark.parametrize("cells", [1, 7, T.CELLS])
def test_rolling_moments_equal_the_join(make_meals, make_readings, cells):
    rng = random.Random(5)
    meals = make_meals([(i, rng.randint(1, 2), rng.randint(0, 2000)) for i in range(80)])
    readings = make_readings([(rng.choice([1, 1, 2]), rng.randint(-600, 2000), rng.choice([5, rng.random() * 90])) for _ in range(500)])
    width = 360 * MIN
    got = T.rolling_moments(meals, readings, "meal_id", ["user_id"], width, ["r_value"], cells=cells).select(
        "meal_id", "n_rows", T.centre("r_value").alias("m"), T.spread("r_value").alias("s")
    )
    want = T.plain_interval_join(meals, readings, ["user_id"], -width, 0, "left").groupBy("meal_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("r_value").alias("m"), F.stddev_samp("r_value").alias("s")
    )
    want = {r.meal_id: r for r in want.collect()}
    for r in got.collect():
        w = want.get(r.meal_id)
        assert r.n_rows == (w.n if w else 0)
        if w:
            assert r.m == pytest.approx(w.m, abs=1e-9)
            assert (r.s is None) == (w.s is None) and (w.s is None or r.s == pytest.approx(w.s, abs=1e-9))


def test_rolling_edges_and_constant_series(make_meals, make_readings):
    day = 24 * 60
    meals = make_meals([(1, 1, 0), (2, 1, 0)])
    series = make_readings([(1, -30 * day, 7), (1, -30 * day - 1 / MIN, 9), (1, -1, 7), (1, 0, 9)])
    got = T.rolling_moments(meals, series, "meal_id", ["user_id"], 30 * day * MIN, ["r_value"])
    for r in got.select("n_rows", T.centre("r_value").alias("m"), T.spread("r_value").alias("s")).collect():
        assert (r.n_rows, r.m, r.s) == (2, 7.0, 0.0)


def test_rolling_windows_of_a_hot_user(spark, make_meals):
    """One user has 90 % of the rows; no task of the plan holds their window whole, and the moments are those of the rows."""
    from tests.conftest import US0

    n = 50_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 300 + 2).otherwise(1).alias("user_id"),
        (F.lit(US0) - F.col("id") * 1_000_000).alias("r_us"),
        F.when(F.col("id") % 10 == 0, 0.1).otherwise(1e6 + F.col("id") % 13).alias("r_value"),
    )
    meals = make_meals([(1, 1, 0), (2, 1, -200), (3, 2, 0.5), (4, 9999, 0)])
    width = 300 * MIN
    got = {r.meal_id: r for r in T.rolling_moments(meals, rows, "meal_id", ["user_id"], width, ["r_value"]).collect()}
    for meal, at in ((1, 0), (2, -200)):
        own = [1e6 + i % 13 for i in range(n) if i % 10 and at * MIN - width <= -i * 1_000_000 < at * MIN]
        mean = sum(own) / len(own)
        assert got[meal].n_rows == len(own)
        assert got[meal].r_value_mean == pytest.approx(mean, rel=1e-12)
        assert got[meal].r_value_m2 == pytest.approx(sum((v - mean) ** 2 for v in own), rel=1e-6)
    assert got[3].r_value_n > 1 and got[3].r_value_mean == 0.1 and got[3].r_value_m2 == 0
    assert got[4].n_rows == 0


def test_first_row_of_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, None), (2, 9, "z")], "k long, o long, v string")
    assert ids(T.first_row(df, ["k"], ["o"])) == [(1, 2, None), (2, 9, "z")]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_four_readings_are_too_few(make_meals, make_readings):
    meals = make_meals([(1, 1, 0), (2, 2, 0)])
    readings = make_readings([(1, t, 100) for t in (5, 10, 15, 20)] + [(2, t, 100) for t in (5, 10, 15, 20, 25)])
    assert [r.meal_id for r in response(meals, readings).collect()] == [2]


def test_first_of_equal_peaks_and_missing_baseline(make_meals, make_readings):
    values = {10: 90, 30: 150, 45: 120, 60: 150, 90: 130, 100: 95}
    r = one(response(make_meals([(1, 1, 0)]), make_readings([(1, t, v) for t, v in values.items()])))
    assert r.glucose_preprandial is None and r.glucose_preprandial_mean is None
    assert (r.peak_value, r.time_to_peak_min, r.amplitude) == (150, 30, 60)
    assert r.recovery_time_min == 70  # 95 <= 90 + 5 at 100


def test_area_by_hand(make_meals, make_readings):
    rows = [(1, 0, 100), (1, 5, 100), (1, 35, 130), (1, 65, 90), (1, 70, 100), (1, 75, 100)]
    r = one(response(make_meals([(1, 1, 0)]), make_readings(rows)))
    assert r.iauc == pytest.approx(900)
    assert r.recovery_time_min == pytest.approx(30)


def test_never_recovers_and_two_hour_mean(make_meals, make_readings):
    rows = [(1, -3, 100), (1, 20, 140), (1, 60, 150), (1, 110, 130), (1, 130, 120), (1, 131, 106)]
    r = one(response(make_meals([(1, 1, 0)]), make_readings(rows)))
    assert r.recovery_time_min is None
    assert r.glucose_2h == 125
    assert r.n_readings_post == 5


def test_area_across_bucket_edges_matches_numpy(make_meals, make_readings):
    import numpy as np

    rng = random.Random(11)
    times = sorted(rng.sample(range(-100, 2000), 400))
    values = [rng.randint(60, 200) for _ in times]
    starts = [rng.randint(0, 1700) for _ in range(40)]
    meals = make_meals([(i, 1, s) for i, s in enumerate(starts)])
    got = {r.meal_id: r for r in response(meals, make_readings([(1, t, v) for t, v in zip(times, values)]), salt=2).collect()}
    t, v = np.array(times), np.array(values, dtype=float)
    seen = 0
    for i, s in enumerate(starts):
        pre = v[(t >= s - 15) & (t <= s)]
        m = (t > s) & (t <= s + 180)
        if m.sum() < 5:
            assert i not in got
            continue
        seen += 1
        base = pre[-1] if len(pre) else v[m][0]
        area = np.trapezoid(np.maximum(v[m] - base, 0), t[m] - s)
        assert got[i].iauc == pytest.approx(area)
        assert got[i].peak_value == v[m].max()
        assert got[i].time_to_peak_min == (t[m] - s)[v[m].argmax()]
        assert got[i].cv_postprandial == pytest.approx(v[m].std() / v[m].mean() * 100)
    assert seen > 20
