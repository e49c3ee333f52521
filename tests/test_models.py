"""Models and client training by their invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.federated import partition as P
from sensorloom.federated import training as T
from sensorloom.models import cluster, learn
from sensorloom.session import durable


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 3))
    y = 100 + 20 * x[:, 0] - 5 * x[:, 1] + rng.normal(0, 1, 240)
    rows = [(i, i % 12, int(i % 12 % 4), *map(float, x[i]), float(y[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "meal_id long, user_id long, fold int, a double, b double, c double, label double")
    return durable(learn.assemble(df, ["a", "b", "c"]))


def test_ridge_is_the_closed_form(table):
    fitted = learn.ridge(1.0)(table).fit(table)
    pdf = table.select("a", "b", "c", "label").toPandas()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["label"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert fitted.coefficients.toArray() == pytest.approx(want, rel=1e-4)


def test_out_of_fold_covers_each_row_once(table):
    oof = learn.out_of_fold(table, learn.ridge(), 4, ["meal_id", "user_id"])
    assert oof.count() == 240 and oof.select("meal_id").distinct().count() == 240
    assert oof.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0] < 2
    for kind in ("plain", "corrected"):
        logged = learn.out_of_fold(table, learn.boosted(rounds=3), 4, ["meal_id"], log=kind)
        assert logged.where(F.col("prediction") < 0).count() == 0 and logged.count() == 240


def test_calibration_is_monotone_and_clipped(spark, table):
    oof = durable(learn.out_of_fold(table, learn.ridge(), 4, ["meal_id"]))
    model = learn.fit_isotonic(oof)
    got = learn.calibrate(model, oof).orderBy("prediction").select("calibrated").toPandas()["calibrated"].to_numpy()
    assert (np.diff(got) >= -1e-9).all()
    ends = learn.calibrate(model, spark.createDataFrame([(-1e6,), (1e6,)], "prediction double")).toPandas()["calibrated"]
    assert ends[0] == pytest.approx(got[0]) and ends[1] == pytest.approx(got[-1])


def test_search_orders_draws(table):
    draws = learn.draw(learn.RANGES["first"], 4)
    assert draws == learn.draw(learn.RANGES["first"], 4)
    for d in draws:
        assert 0.01 <= d["stepSize"] <= 0.15 and 200 <= d["maxIter"] <= 1000
    params = [{**d, "maxIter": 2, "maxDepth": 2} for d in draws[:2]]
    scores, best = learn.search(table, learn.boosted(), params, 4)
    got = [r.score for r in scores.collect()]
    assert got == sorted(got) and best in params


def test_importance_and_round_trip(spark, table, tmp_path):
    top = learn.importance(learn.boosted(rounds=3), table, ["a", "b", "c"]).collect()
    assert top[0].feature == "a" and sum(r.importance for r in top) == pytest.approx(1)
    model = learn.fit_pipeline(table.drop("features"), learn.boosted(rounds=2), ["b", "a"])
    learn.save(model, str(tmp_path / "m"))
    back = learn.load_pipeline(str(tmp_path / "m"))
    assert learn.feature_order(back) == ["b", "a"]
    one = model.transform(table.drop("features")).select("meal_id", "prediction")
    two = back.transform(table.drop("features")).select("meal_id", "prediction")
    assert one.exceptAll(two).count() == 0


def test_class_weight(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2, "label double")
    assert {(r.label, r.weight) for r in learn.class_weight(df).collect()} == {(0.0, 1.0), (1.0, 3.0)}


def test_silhouette_of_known_points(spark):
    pts = [(0.0, 0.0, 0), (0.0, 1.0, 0), (5.0, 5.0, 1), (5.0, 6.5, 1), (9.0, 9.0, 2)]
    df = learn.assemble(spark.createDataFrame(pts, "x double, y double, cluster int"), ["x", "y"])
    x, c = np.array([p[:2] for p in pts]), np.array([p[2] for p in pts])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        same = (c == c[i]) & (np.arange(len(x)) != i)
        if not same.any():
            s.append(0.0)
            continue
        a = d[i][same].mean()
        b = min(d[i][c == k].mean() for k in set(c) - {c[i]})
        s.append((b - a) / max(a, b))
    assert cluster.silhouette(df) == pytest.approx(np.mean(s))


def test_kmeans_finds_the_groups(spark):
    pts = [(float(g * 10 + i % 3), g) for g in range(3) for i in range(20)]
    df = durable(spark.createDataFrame(pts, "x double, g int"))
    got = cluster.kmeans(df, ["x"], 3, restarts=3).groupBy("g").agg(F.count_distinct("cluster").alias("n"))
    assert {r.n for r in got.collect()} == {1}


# --- clients ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    # label 0 holds a third of all rows
    y = np.where(rng.random(600) < 1 / 3, 0, rng.integers(0, 6, 600))
    centre = rng.normal(0, 1, (6, 4))
    x = centre[y] + rng.normal(0, 0.4, (600, 4))
    rows = [(i, [float(v) for v in (x[i] * 0.5 + 0.5)], int(y[i])) for i in range(600)]
    return durable(spark.createDataFrame(rows, "id long, embedding array<float>, label int"))


def test_every_row_gets_one_client(labelled):
    for df in (
        P.iid(labelled, ["id"], 5),
        P.dirichlet(labelled, ["id"], "label", 5, 0.1),
        P.dirichlet(labelled, ["id"], "label", 5, 0.5, least=10, balance=True),
        P.pathological(labelled, ["id"], "label", 5, 2),
    ):
        assert df.count() == 600 and df.select("id").distinct().count() == 600
        assert df.where(F.col("partition_id").isNull() | ~F.col("partition_id").between(0, 4)).count() == 0


def test_sizes_and_labels_of_clients(labelled):
    sizes = [r["count"] for r in P.iid(labelled, ["id"], 7).groupBy("partition_id").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    kinds = P.pathological(labelled, ["id"], "label", 5, 2).groupBy("partition_id").agg(F.count_distinct("label").alias("n"))
    assert all(r.n <= 2 for r in kinds.collect())
    balanced = P.dirichlet(labelled, ["id"], "label", 5, 0.5, least=10, balance=True).groupBy("partition_id").count()
    assert all(r["count"] >= 10 for r in balanced.collect())
    even = P.dirichlet(labelled, ["id"], "label", 4, 1e6).groupBy("label", "partition_id").count()
    assert even.groupBy("label").agg((F.max("count") - F.min("count")).alias("d")).where("d > 2").count() == 0


def test_moves_fill_up_small_clients():
    for sizes, least in (([44, 109, 156, 47, 144], 60), ([0, 500, 1, 0], 100), ([10, 10], 10), ([1, 2, 3], 50), ([0, 0], 5)):
        give, take = P.moves(sizes, least)
        after = [s - g + t for s, g, t in zip(sizes, give, take)]
        assert sum(give) == sum(take) and sum(after) == sum(sizes)
        assert all(s - g >= least for s, g in zip(sizes, give) if g)
        if sum(sizes) >= least * len(sizes):
            assert min(after) >= least


def test_gamma_variates(spark):
    for alpha in (0.1, 0.5, 3.0):
        got = spark.range(20000).select(P.gamma(alpha, "test", F.col("id").cast("string")).alias("g")).agg(F.avg("g"), F.var_pop("g"), F.min("g")).first()
        assert got[0] == pytest.approx(alpha, rel=0.1) and got[1] == pytest.approx(alpha, rel=0.2) and got[2] >= 0


def test_dirichlet_keeps_rows_without_a_label(spark, labelled):
    odd = labelled.select("id", F.when(F.col("id") % 50 > 0, F.col("label")).alias("label"))
    for least in (0, 110):
        got = P.dirichlet(odd, ["id"], "label", 5, 0.1, least=least)
        sizes = {r.partition_id: r["count"] for r in got.groupBy("partition_id").count().collect()}
        assert sum(sizes.values()) == 600 and (not least or min(sizes.values()) >= 110 and len(sizes) == 5)


def test_dirichlet_does_not_depend_on_layout(labelled):
    a = P.dirichlet(labelled, ["id"], "label", 5, 0.1).select("id", "partition_id")
    b = P.dirichlet(labelled.repartition(13), ["id"], "label", 5, 0.1).select("id", "partition_id")
    assert a.exceptAll(b).count() == 0


def test_split_takes_the_ceiling(labelled):
    parts = P.split_local(P.iid(labelled, ["id"], 7), ["id"])
    for r in parts.groupBy("partition_id").agg(F.count("id").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r.t == -(-r.n // 5)


def test_weighted_mean_of_parameters(spark):
    df = spark.createDataFrame([("w", [1.0, 2.0], 10), ("w", [3.0, 6.0], 30)], "block string, values array<double>, n_examples long")
    assert T.weighted_mean(df).first()["values"] == [2.5, 5.0]
    same = df.withColumn("values", F.array(F.lit(7.0), F.lit(8.0)))
    assert T.weighted_mean(same).first()["values"] == [7.0, 8.0]


def specs():
    return [{"name": "a", "clients": 3, "kind": "iid"}, {"name": "b", "clients": 3, "kind": "pathological", "classes": 2}]


def assigned(labelled):
    out = None
    for s in specs():
        part = P.assign(labelled, ["id"], "label", s).withColumn("experiment", F.lit(s["name"]))
        out = part if out is None else out.unionByName(part)
    return out


def by_hand(x, y, classes, rate, epochs, momentum):
    x = np.hstack([(x - 0.5) / 0.5, np.ones((len(x), 1))])
    w = np.zeros((classes, x.shape[1]))
    speed, losses = np.zeros_like(w), []
    for _ in range(epochs):
        z = x @ w.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        p[np.arange(len(y)), y] -= 1
        speed = momentum * speed + p.T @ x / len(x)
        w = w - rate * speed
    return w.ravel(), float(np.mean(losses))


def zero_start(spark, names, n):
    return spark.createDataFrame([(name, [0.0] * n) for name in names], "experiment string, values array<double>")


def test_local_training_is_gradient_descent_on_each_client(spark, labelled):
    clients = T.prepare_clients(assigned(labelled), ["id"], "embedding", "label").where(F.col("split") == "train")
    out = T.local_training(clients, zero_start(spark, "ab", 30), 6, 4, 0.5, 3, 0.9)
    got = {(r.experiment, r.partition_id, r.block): r for r in out.collect()}
    assert len(got) == 12
    raw = labelled.select("id", "embedding").join(clients.select("id", "experiment", "partition_id", "label"), "id").toPandas()
    for key, part in raw.groupby(["experiment", "partition_id"]):
        w, loss = by_hand(np.array(part["embedding"].tolist(), float), part["label"].to_numpy(), 6, 0.5, 3, 0.9)
        assert got[*key, "linear"]["values"] == pytest.approx(w.tolist(), abs=1e-9)
        assert got[*key, "train_loss"]["values"] == pytest.approx([loss])
        assert got[*key, "linear"].n_examples == len(part)


def test_local_training_has_one_rule_at_every_size(spark):
    """Two rows repeated beyond the former limit of a shard (20,000) give the step of the two rows."""
    two = [([0.1, 0.9], 0), ([0.8, 0.3], 1)]
    kind = "x array<double>, label int"
    few = spark.createDataFrame(two, kind).withColumns({"experiment": F.lit("a"), "partition_id": F.lit(0)})
    many = few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(15_000)))).drop("copy")
    odd = spark.createDataFrame([(None, 0), ([0.5, 0.5], None), ([0.5, 0.5], 9)], kind)
    odd = odd.withColumns({"experiment": F.lit("a"), "partition_id": F.lit(0)})
    results = []
    for rows in (few, many, many.unionByName(odd)):
        out = T.local_training(rows, zero_start(spark, "a", 6), 2, 2, 0.1, 2, 0.9).where("block = 'linear'")
        results.append(out.first())
    assert [r.n_examples for r in results] == [2, 30_000, 30_000]
    for r in results[1:]:
        assert r["values"] == pytest.approx(results[0]["values"], abs=1e-12)


def test_published_settings(spark):
    """Of the production model, and no query sets others."""
    import inspect

    from sensorloom.plans import q_models

    model = learn.boosted_production()
    got = (model.getMaxIter(), model.getMaxDepth(), model.getStepSize(), model.getSubsamplingRate(), model.getFeatureSubsetStrategy())
    assert got == (455, 9, 0.0193, 0.813, "0.826") and model.getMinInstancesPerNode() == 47
    text = inspect.getsource(q_models)
    assert "rounds=" not in text and "depth=" not in text and "ROUNDS" not in text
