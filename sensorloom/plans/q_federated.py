"""Partitioning over clients, weighted averaging and training rounds."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sensorloom.federated import partition as P
from sensorloom.federated import training as T
from sensorloom.functions import fixed
from sensorloom.functions.columns import normalise
from sensorloom.plans.q_response import r6
from sensorloom.plans.q_sources import IID5
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import r
from sensorloom.sources import roles

CLASSES, WIDTH = 10, 64


@query("l01_iid", IID5)
def iid(spark, sf_dir):
    return P.iid(roles.arrays(spark, sf_dir), ["id"], 5).select("id", "label", "partition_id")


def uniform_sql(*parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"((('0x' || md5({text})[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)"


def dirichlet_sql(alpha: float, least: int, balance: bool, k: int = 5) -> str:
    """The shares as P.dirichlet draws them, label by label; then the moves that give each client `least` rows."""
    d = alpha + 2 / 3
    of = ("'dirichlet:42'", "label", "c", "t")
    give = f"greatest(s - {least}, 0)"
    rows = f"SELECT rk.id, rk.label, len([e for e in ends if e < p]) AS client FROM rk JOIN f ON f.label = rk.label AND f.i > 0"
    moved = (
        "SELECT id, label, CAST(CASE WHEN j > s - give THEN len([u for u in upto if u < give_before + j - (s - give)]) ELSE client END"
        " AS INTEGER) AS partition_id FROM nb JOIN mv USING (client), (SELECT list(take_upto ORDER BY client) AS upto FROM mv)"
    )
    return (
        "WITH RECURSIVE lab AS (SELECT label, count(*) AS n, row_number() OVER (ORDER BY label) AS i FROM embeddings GROUP BY label),"
        f" x AS (SELECT label, c, t, sqrt(-2 * ln({uniform_sql(*of, chr(39) + 'a' + chr(39))})) * cos({2 * math.pi!r} * {uniform_sql(*of, chr(39) + 'b' + chr(39))}) AS x,"
        f" ln({uniform_sql(*of, chr(39) + 'c' + chr(39))}) AS lu FROM lab, range(0, {k}) a(c), range(1, {P.TRIES + 1}) b(t)),"
        f" v AS (SELECT *, pow(1 + {1 / math.sqrt(9 * d)!r} * x, 3.0) AS v FROM x),"
        f" g AS (SELECT label, c, arg_min({d!r} * v, t) * any_value(pow({uniform_sql(*of[:3], chr(39) + 'd' + chr(39))}, {1 / alpha!r})) AS g FROM v"
        f" WHERE v > 0 AND lu < 0.5 * x * x + {d!r} - {d!r} * v + {d!r} * ln(CASE WHEN v > 0 THEN v END) GROUP BY label, c),"
        " gs AS (SELECT i, label, n, list(g ORDER BY c) AS g FROM g JOIN lab USING (label) GROUP BY i, label, n),"
        " ev AS (SELECT sum(n) / " + f"{k}.0 AS even FROM lab),"
        f" f AS (SELECT 0::BIGINT AS i, NULL::INTEGER AS label, [0.0::DOUBLE for z in range({k})] AS sizes, []::DOUBLE[] AS ends"
        " UNION ALL SELECT i, label, [sizes[z] + ends[z] - (CASE WHEN z > 1 THEN ends[z - 1] ELSE 0 END) for z in range(1, " + f"{k + 1})] AS sizes, ends FROM ("
        f" SELECT i, label, sizes, [CASE WHEN z = {k} THEN n ELSE floor((CASE WHEN list_sum(o) > 0 THEN list_sum(o[1:z]) / list_sum(o) ELSE z / {k}.0 END) * n + 1e-9) END"
        f" for z in range(1, {k + 1})]::DOUBLE[] AS ends FROM (SELECT gs.i, gs.label, gs.n, f.sizes,"
        f" [CASE WHEN {str(not balance).lower()} OR f.sizes[z] < even THEN gs.g[z] ELSE 0 END for z in range(1, {k + 1})] AS o FROM f JOIN gs ON gs.i = f.i + 1, ev))),"
        " rk AS (SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS p FROM embeddings),"
        f" dl AS ({rows}),"
        f" sz AS (SELECT c AS client, count(id) AS s FROM range(0, {k}) a(c) LEFT JOIN dl ON dl.client = c GROUP BY c),"
        f" td AS (SELECT least(sum(greatest({least} - s, 0)), sum({give})) AS total, sum({give}) AS spare FROM sz),"
        f" gv AS (SELECT client, s, total * sum({give}) OVER (ORDER BY client) // greatest(spare, 1) AS give_upto,"
        f" least(sum(greatest({least} - s, 0)) OVER (ORDER BY client), total) AS take_upto FROM sz, td),"
        " mv AS (SELECT *, coalesce(lag(give_upto) OVER (ORDER BY client), 0) AS give_before,"
        " give_upto - coalesce(lag(give_upto) OVER (ORDER BY client), 0) AS give FROM gv),"
        " nb AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY md5('42:move:' || id), id) AS j FROM dl) " + moved
    )


@query("l02_dirichlet", dirichlet_sql(0.1, 0, False))
def dirichlet(spark, sf_dir):
    return P.dirichlet(roles.arrays(spark, sf_dir), ["id"], "label", 5, 0.1).select("id", "label", "partition_id")


@query("l02_dirichlet_balanced", dirichlet_sql(0.5, 10, True))
def dirichlet_balanced(spark, sf_dir):
    return P.dirichlet(
        roles.arrays(spark, sf_dir), ["id"], "label", 5, 0.5, least=10, balance=True
    ).select("id", "label", "partition_id")


@query("l02_dirichlet_filled", dirichlet_sql(0.1, 60, False))
def dirichlet_filled(spark, sf_dir):
    """Strong skew and a least size that the draw alone does not give."""
    return P.dirichlet(roles.arrays(spark, sf_dir), ["id"], "label", 5, 0.1, least=60).select("id", "label", "partition_id")


@query(
    "l03_pathological",
    "WITH lab AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM (SELECT DISTINCT label FROM embeddings)),"
    " own AS (SELECT c, (c * 2 + j) % (SELECT count(*) FROM lab) AS i FROM range(0, 5) a(c), range(0, 2) b(j)),"
    " o AS (SELECT label, list(c ORDER BY c) AS cs FROM own JOIN lab USING (i) GROUP BY label),"
    " rk AS (SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) - 1 AS p"
    " FROM embeddings) SELECT id, label, CAST(cs[p % len(cs) + 1] AS INTEGER) AS partition_id FROM rk LEFT JOIN o USING (label)",
)
def pathological(spark, sf_dir):
    return P.pathological(roles.arrays(spark, sf_dir), ["id"], "label", 5, 2).select("id", "label", "partition_id")


@query(
    "l04_local_split",
    f"WITH p AS ({IID5}) SELECT id, partition_id, CASE WHEN row_number() OVER (PARTITION BY partition_id ORDER BY"
    " md5('split42:' || id), id) <= ceil(0.2 * count(*) OVER (PARTITION BY partition_id)) THEN 'test' ELSE 'train' END AS split"
    " FROM p",
)
def local_split(spark, sf_dir):
    parts = P.iid(roles.arrays(spark, sf_dir), ["id"], 5)
    return P.split_local(parts, ["id"]).select("id", "partition_id", "split")


@query(
    "e24_normalise",
    "SELECT vec_id AS id, " + r("list_sum(list_transform(embedding, lambda x: (CAST(x AS DOUBLE) - 0.5) / 0.5))")
    + " AS total, " + r("(CAST(embedding[1] AS DOUBLE) - 0.5) / 0.5") + " AS head FROM embeddings",
)
def normalised(spark, sf_dir):
    x = roles.arrays(spark, sf_dir).select("id", normalise("embedding").alias("x"))
    total = F.aggregate("x", F.lit(0.0), lambda s, v: s + v)
    return r6(x.select("id", total.alias("total"), F.get("x", F.lit(0)).alias("head")), "total", "head")


@query(
    "a42_weighted_parameters",
    f"WITH p AS ({IID5}), e AS (SELECT partition_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings JOIN p ON p.id = vec_id,"
    " range(1, 65) t(i)), m AS (SELECT partition_id, i, avg(v) AS v, count(*) AS n FROM e GROUP BY partition_id, i)"
    f" SELECT CAST(i - 1 AS INTEGER) AS pos, {r('sum(v * n) / sum(n)')} AS value FROM m GROUP BY i",
)
def fed_avg(spark, sf_dir):
    """Client parameters here are the mean arrays of the clients' rows."""
    rows = P.iid(roles.arrays(spark, sf_dir), ["id"], 5)
    items = rows.select("partition_id", F.posexplode("embedding").alias("i", "v"))
    means = items.groupBy("partition_id", "i").agg(F.avg("v").alias("m"), F.count(F.lit(1)).alias("n"))
    clients = means.groupBy("partition_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("values"),
        F.max("n").alias("n_examples"),
    )
    mean = T.weighted_mean(clients.withColumn("block", F.lit("mean")))
    return r6(mean.select(F.posexplode("values").alias("pos", "value")), "value")


@query(
    "a43_weighted_metrics",
    f"WITH p AS ({IID5}), m AS (SELECT partition_id, count(*) AS n, avg(CASE WHEN label < 5 THEN 1.0 ELSE 0 END) AS acc FROM p"
    f" GROUP BY partition_id) SELECT {r('sum(acc * n) / sum(n)')} AS acc FROM m",
)
def fed_metrics(spark, sf_dir):
    parts = P.iid(roles.arrays(spark, sf_dir), ["id"], 5)
    by = parts.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("n_examples"), F.avg((F.col("label") < 5).cast("double")).alias("acc")
    )
    return r6(T.weighted_metrics(by, ["acc"]), "acc")


def split_table(spark, sf_dir):
    """Rows with the central split; ids, array and label."""
    return P.split_local(roles.arrays(spark, sf_dir), ["id"], within=(), seed=7)


def class_means(train):
    """Fixed weights from the class means: linear scores of the nearest mean."""
    items = train.select("label", F.posexplode("x").alias("i", "v"))
    mean = items.groupBy("label", "i").agg(F.avg("v").alias("m"))
    rows = mean.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("w")
    )
    bias = F.aggregate("w", F.lit(0.0), lambda s, v: s - v * v / 2)
    flat = rows.select("label", F.concat("w", F.array(bias)).alias("w"))
    return flat.groupBy(F.lit("means").alias("experiment")).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("label", "w"))), lambda s: s["w"])).alias("values")
    )


L8_SPLIT = (
    "SELECT vec_id, label, list_transform(embedding, lambda x: (CAST(x AS DOUBLE) - 0.5) / 0.5) AS x,"
    " row_number() OVER (ORDER BY md5('split7:' || vec_id), vec_id) <= ceil(0.2 * count(*) OVER ()) AS test FROM embeddings"
)


@query(
    "l08_central_evaluation",
    f"WITH s AS ({L8_SPLIT}), e AS (SELECT label, i, avg(x[i]) AS m FROM s, range(1, 65) t(i) WHERE NOT test GROUP BY label, i),"
    " w AS (SELECT label AS c, list(m ORDER BY i) AS w, -sum(m * m) / 2 AS b FROM e GROUP BY label),"
    " z AS (SELECT vec_id, label, c, list_dot_product(x, w) + b AS z FROM s, w WHERE test),"
    " t AS (SELECT vec_id, label, max(z) AS top, arg_max(c, z) AS best, ln(sum(exp(z - m))) + any_value(m) AS lse,"
    " max(z) FILTER (WHERE c = label) AS own FROM (SELECT *, max(z) OVER (PARTITION BY vec_id) AS m FROM z) GROUP BY vec_id, label)"
    f" SELECT {r('avg(lse - own)')} AS loss, {r('avg(CASE WHEN best = label THEN 1.0 ELSE 0 END)')} AS accuracy,"
    " count(*) AS n_examples FROM t",
)
def central_evaluation(spark, sf_dir):
    rows = split_table(spark, sf_dir).select("id", "split", "label", normalise("embedding").alias("x"))
    params = class_means(rows.where(F.col("split") == "train"))
    test = rows.where(F.col("split") == "test").select("x", "label", F.lit("means").alias("experiment"))
    out = T.evaluate(test, params, CLASSES, WIDTH, ["experiment"]).drop("experiment")
    return r6(out, "loss", "accuracy")


L5_STEP = (
    f"WITH s AS ({L8_SPLIT}), p AS (SELECT vec_id, label, x, CAST((row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) - 1)"
    " % 5 AS INTEGER) AS partition_id FROM s WHERE NOT test), k AS (SELECT *, row_number() OVER (PARTITION BY partition_id"
    " ORDER BY md5('split42:' || vec_id), vec_id) <= ceil(0.2 * count(*) OVER (PARTITION BY partition_id)) AS held FROM p),"
    " e AS (SELECT partition_id, c, i, ((0.1 - CASE WHEN label = c THEN 1.0 ELSE 0 END)"
    " * CASE WHEN i = 65 THEN 1.0 ELSE x[i] END) AS g FROM k, range(0, 10) a(c), range(1, 66) b(i) WHERE NOT held),"
    f" t AS (SELECT partition_id, 'linear' AS block, CAST(c * 65 + i - 1 AS INTEGER) AS pos, -{fixed.FED_RATE} * avg(g) AS value,"
    " count(*) AS n_examples FROM e GROUP BY partition_id, c, i UNION ALL SELECT partition_id, 'train_loss', 0, ln(10), count(*)"
    " FROM k WHERE NOT held GROUP BY partition_id)"
)  # from zero weights all classes are equally likely, so the step is a mean of known errors


def one_step(spark, sf_dir):
    """Each client's parameters after an epoch from zero weights."""
    spec = fixed.FED_EXPERIMENTS[0]
    train = split_table(spark, sf_dir).where(F.col("split") == "train").drop("split")
    assigned = P.assign(train, ["id"], "label", spec).withColumn("experiment", F.lit(spec["name"]))
    clients = T.prepare_clients(assigned, ["id"], "embedding", "label").where(F.col("split") == "train")
    zeros = F.array_repeat(F.lit(0.0), CLASSES * (WIDTH + 1))
    start = spark.range(1).select(F.lit(spec["name"]).alias("experiment"), zeros.alias("values"))
    return T.local_training(
        clients, start, CLASSES, WIDTH, fixed.FED_RATE, fixed.FED_LOCAL_EPOCHS, fixed.FED_MOMENTUM
    )


@query("l05_local_training", f"{L5_STEP} SELECT 'small-iid' AS experiment, partition_id, block, pos, {r('value', 9)} AS value, n_examples FROM t")
def local_training(spark, sf_dir):
    out = one_step(spark, sf_dir).select(
        "experiment", "partition_id", "block", F.posexplode("values").alias("pos", "value"), "n_examples"
    )
    return out.withColumn("value", F.round("value", 9) + F.lit(0.0))


@query(
    "l06_average_parameters",
    f"{L5_STEP} SELECT 'small-iid' AS experiment, block, pos, {r('sum(value * n_examples) / sum(n_examples)', 9)} AS value"
    " FROM t GROUP BY block, pos",
)
def average(spark, sf_dir):
    mean = T.weighted_mean(one_step(spark, sf_dir), ["experiment", "block"])
    out = mean.select("experiment", "block", F.posexplode("values").alias("pos", "value"))
    return out.withColumn("value", F.round("value", 9) + F.lit(0.0))


@query(
    "a44_experiment_summary",
    "WITH h AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'small-iid' WHEN '2-HIGH' THEN 'large-iid' WHEN '3-MEDIUM' THEN"
    " 'small-dirichlet' WHEN '4-NOT SPECIFIED' THEN 'large-dirichlet' ELSE 'small-pathological' END AS experiment,"
    " month(o_orderdate) AS round, avg(o_totalprice) AS accuracy, max(o_totalprice) AS loss FROM orders GROUP BY ALL),"
    " w AS (SELECT experiment, max(accuracy) FILTER (WHERE round = 1) AS acc_r1, max(accuracy) FILTER (WHERE round = 5) AS acc_r5,"
    " max(accuracy) FILTER (WHERE round = 10) AS acc_r10, max(loss) FILTER (WHERE round = 10) AS loss_r10 FROM h GROUP BY 1),"
    " k AS (SELECT *, split_part(experiment, '-', 2) AS kind, CASE WHEN experiment LIKE 'small%' THEN 5 ELSE 20 END AS clients FROM w)"
    f" SELECT kind, experiment, {r('acc_r1')} AS acc_r1, {r('acc_r5')} AS acc_r5, {r('acc_r10')} AS acc_r10,"
    f" {r('loss_r10')} AS loss_r10, CAST(clients AS INTEGER) AS clients,"
    f" {r('first_value(acc_r10) OVER (PARTITION BY kind ORDER BY clients) - first_value(acc_r10) OVER (PARTITION BY kind ORDER BY clients DESC)')}"
    " AS gap_few_many FROM k",
)
def experiment_summary(spark, sf_dir):
    """The report on any history table: here orders by priority and month."""
    names = {
        "1-URGENT": "small-iid", "2-HIGH": "large-iid", "3-MEDIUM": "small-dirichlet", "4-NOT SPECIFIED": "large-dirichlet",
        "5-LOW": "small-pathological",
    }
    from sensorloom.functions.columns import map_values

    history = roles.table(spark, sf_dir, "orders").groupBy(
        map_values("o_orderpriority", names).alias("experiment"), F.month("o_orderdate").alias("round")
    ).agg(F.avg("o_totalprice").alias("accuracy"), F.max("o_totalprice").alias("loss"))
    return r6(T.summary(history, fixed.FED_EXPERIMENTS), "acc_r1", "acc_r5", "acc_r10", "loss_r10", "gap_few_many")
