"""Ridge from sufficient statistics, the search by halving, and the store of stages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.models import learn, ridge, search
from sensorloom.session import durable, scratch_dir
from sensorloom.sources.store import Store

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) * [1, 1000, 1e-3] + [0, 1e6, 5]
    y = 3 * x[:, 0] + 0.01 * x[:, 1] - 40 * x[:, 2] + rng.normal(0, 1, 300)
    rows = [(i, i % 5, *map(float, x[i]), float(y[i]), float(rng.integers(1, 4))) for i in range(300)]
    return durable(spark.createDataFrame(rows, "meal_id long, fold int, a double, b double, c double, label double, w double").repartition(6))


def closed(x, y, w, alpha):
    xm, ym = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc = x - xm
    b = np.linalg.solve((xc * w[:, None]).T @ xc + alpha * np.eye(x.shape[1]), (xc * w[:, None]).T @ (y - ym))
    return ym - xm @ b, b


@pytest.mark.parametrize("weight", [None, "w"])
def test_ridge_equals_the_closed_form_in_each_fold(table, weight):
    pdf = table.toPandas()
    m = ridge.moments(table, COLUMNS, weight=weight)
    for alpha in (0.0, 1.0, 100.0):
        for fold in (None, *range(5)):
            part = pdf if fold is None else pdf[pdf.fold != fold]
            b0, b = closed(part[COLUMNS].to_numpy(), part.label.to_numpy(), part.w.to_numpy() if weight else np.ones(len(part)), alpha)
            got0, got = m.fit(alpha, fold)
            assert got == pytest.approx(b, rel=1e-6, abs=1e-9) and got0 == pytest.approx(b0, rel=1e-6, abs=1e-6)


def test_one_predicts_what_the_other_does(table):
    """The two ridges of the library agree."""
    own = ridge.out_of_fold(table, COLUMNS, ["meal_id"])
    other = learn.out_of_fold(learn.assemble(table, COLUMNS), learn.ridge(), 5, ["meal_id"])
    both = own.join(other.select("meal_id", F.col("prediction").alias("p")), "meal_id")
    assert both.count() == 300 and both.where(F.abs(F.col("prediction") - F.col("p")) > 1e-3).count() == 0


def test_ridge_of_odd_tables(spark, table):
    odd = table.unionByName(spark.createDataFrame([(1000, 0, None, 1.0, 1.0, 1.0, 1.0), (1001, None, 1.0, 1.0, 1.0, 1.0, 1.0), (1002, 1, float("nan"), 1.0, 1.0, 1.0, 1.0)], table.schema))
    assert ridge.moments(odd, COLUMNS).fit(1.0)[1] == pytest.approx(ridge.moments(table, COLUMNS).fit(1.0)[1], rel=1e-9)
    assert ridge.out_of_fold(table.limit(0), COLUMNS, ["meal_id"]).count() == 0
    same = table.withColumn("a", F.lit(7.0))  # no spread
    b0, b = ridge.moments(same, COLUMNS).fit(1.0)
    assert b[0] == 0 and np.isfinite(b0)


def test_search_goes_on_where_it_stopped(spark, table):
    alphas = search.log_draws(1e-3, 1e6, 9)
    scores = search.ridge_scores(table, COLUMNS, alphas)
    path, asked = scratch_dir(spark), []

    def counted(draws, budget):
        asked.append((len(draws), budget))
        return scores(draws, budget)

    first = search.halving(table, 9, (1, 3, 5), counted, path).collect()
    again = search.halving(table, 9, (1, 3, 5), counted, path).collect()
    assert asked == [(9, 1), (3, 3), (1, 5)] and sorted(first) == sorted(again)  # the second time all rungs are there
    assert {(r.rung, r.n_folds) for r in first} == {(0, 1), (1, 3), (2, 5)}
    pdf = table.toPandas()
    best = next(r for r in first if r.rung == 2)
    errors = []
    for fold in range(5):
        train, test = pdf[pdf.fold != fold], pdf[pdf.fold == fold]
        b0, b = closed(train[COLUMNS].to_numpy(), train.label.to_numpy(), np.ones(len(train)), alphas[best.draw])
        errors.append(np.abs(test.label - b0 - test[COLUMNS].to_numpy() @ b).mean())
    assert best.goes_on and best.score == pytest.approx(np.mean(errors))


def test_boosted_search_scores_every_prefix(spark, table):
    rows = learn.assemble(table, COLUMNS)
    params = [{"maxDepth": 1, "stepSize": 0.5}, {"maxDepth": 2, "stepSize": 0.5, "maxIter": 2}]
    scores = search.boosted_scores(rows, learn.boosted(), params, 2, fold="half")
    rows = rows.withColumn("half", F.col("fold") % 2)
    scores = search.boosted_scores(rows, learn.boosted(), params, 2, fold="half")
    found = scores([0, 1], 3).collect()
    assert sorted({(r.draw, r.rounds) for r in found}) == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)]
    model = learn.boosted(rounds=3, depth=1, rate=0.5).fit(rows.where("half = 1"))
    want = model.transform(rows.where("half = 0")).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert next(r.score for r in found if (r.draw, r.fold, r.rounds) == (0, 0, 3)) == pytest.approx(want)


def test_best_rounds_and_places(spark):
    rows = [(0, 0, 1, 5.0), (0, 1, 1, 7.0), (0, 0, 2, 4.0), (0, 1, 2, 4.0), (1, 0, 1, 4.0), (1, 1, 1, 4.0), (2, 0, 1, 9.0), (2, 1, 1, 1.0)]
    got = search.ranked(spark.createDataFrame(rows, search.SCHEMA), 2).orderBy("place").collect()
    assert [(r.draw, r.rounds, r.score, r.goes_on) for r in got] == [(0, 2, 4.0, True), (1, 1, 4.0, True), (2, 1, 5.0, False)]
    got = search.ranked(spark.createDataFrame(rows, search.SCHEMA), 1, larger=True).orderBy("place").collect()
    assert [(r.draw, r.rounds) for r in got] == [(0, 1), (2, 1), (1, 1)]


def test_store_fits_once_and_again_when_the_data_change(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(str(tmp_path / "t.parquet")), ["x"]

    def count(**settings):
        table, note = Store(spark, str(tmp_path), ("t",), **settings).table("stage", make)
        assert note == ["x"]
        return table.count()

    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert (count(k=1), count(k=1), len(made)) == (3, 3, 1)
    assert (count(k=2), len(made)) == (3, 2)
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert (count(k=1), len(made)) == (4, 3)


def test_store_keeps_models(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t.parquet"))
    made = []

    def make():
        made.append(1)
        return learn.fit_pipeline(table, learn.ridge(), COLUMNS)

    models = [Store(spark, str(tmp_path), ("t",)).model("ridge", make) for _ in range(2)]
    assert len(made) == 1 and [learn.feature_order(m) for m in models] == [COLUMNS] * 2
    a, b = (m.transform(table).select("meal_id", "prediction") for m in models)
    assert a.exceptAll(b).count() == 0
