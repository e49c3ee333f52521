"""The model plans end to end on the smallest tables, with few trees."""

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import folds
from sensorloom.plans import modelling as G
from sensorloom.plans import q_models as Q
from sensorloom.sources import roles

SF = "/root/testdata/sf0.001"
FEW = {"rounds": (2, 3), "depth": (2, 3), "rate": (0.05, 0.1), "rows": (0.8, 1.0), "columns": (0.5, 1.0), "leaf": (5, 9)}


@pytest.fixture(scope="module")
def dataset(spark):
    return Q.dataset(spark, SF)


def test_benchmark_ranks_models(dataset):
    rows = G.benchmark(dataset, rounds=2, trees=3).orderBy("place").collect()
    assert [r.place for r in rows] == [1, 2, 3, 4] and rows[0].is_best
    assert [r.mae for r in rows] == sorted(r.mae for r in rows)


def test_production_fits_searches_calibrates_and_scores(spark, dataset):
    from sensorloom.models import learn

    clustered = G.with_clusters(dataset, G.cluster_profiles(dataset, roles.readings(spark, SF), restarts=2))
    assert clustered.count() == dataset.count()
    made = G.production(clustered, rounds=2, draws=2, late_rounds=2, ranges=FEW)
    assert "nutri_cluster_num" in made["columns"] and set(made["late_columns"]) - set(made["columns"])
    assert {r.model for r in made["results"].collect()} == {"plain", "weighted", "searched", "calibrated"}
    assert made["search"].count() == 2
    preds = made["predictions"]
    assert preds.count() == dataset.where("peak_value > 0").count()
    assert preds.where("calibrated is null").count() == 0
    late = made["late_predictions"]
    assert late.where(~F.col("probability").between(0, 1)).count() == 0
    rows = G.scoring_table(clustered, list(dict.fromkeys([*made["columns"], *made["late_columns"], "not_there"])))
    assert rows.where("not_there <> 0").count() == 0
    scored = learn.score(rows, made["peak"], made["calibrator"], made["late"])
    assert scored.count() == clustered.count()
    assert scored.where("peak_value_predicted is null or ttp_label is null").count() == 0
    ends = preds.agg(F.min("calibrated").alias("lo"), F.max("calibrated").alias("hi")).first()
    assert scored.where(~F.col("peak_value_predicted").between(ends.lo - 1e-6, ends.hi + 1e-6)).count() == 0


def test_folds_of_training_table_keep_users_whole(dataset):
    rows, columns = G.peak_table(dataset)
    assert rows.groupBy("user_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert rows.select([F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first() == tuple([0] * len(columns))


def test_impute_by_fold_does_not_look_at_its_own_rows(spark):
    df = spark.createDataFrame([(0, None), (0, 100.0), (1, 1.0), (1, 3.0), (1, None)], "fold int, x double")
    got = sorted((r.fold, r.x) for r in folds.impute_median_by_fold(df, ["x"], 2).collect())
    assert got == [(0, 2.0), (0, 100.0), (1, 1.0), (1, 3.0), (1, 100.0)]
