"""Scans and sinks. Round trips write to a new folder under the shared one."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.federated.partition import iid, split_local
from sensorloom.operators import clean as L
from sensorloom.operators.metrics import user_weights
from sensorloom.operators.profiles import source_profile
from sensorloom.plans.q_clean import TIMES
from sensorloom.plans.q_metrics import PRED, WEIGHT, predictions
from sensorloom.plans.q_response import r6, responses
from sensorloom.plans.registry import query
from sensorloom.plans.sql_text import r
from sensorloom.session import scratch_dir
from sensorloom.sources import io, roles


@query("s01_csv_scan", f"WITH t AS ({TIMES}) SELECT id AS user_id, t AS ts, value_decimal FROM t")
def csv_scan(spark, sf_dir):
    folder = scratch_dir(spark)
    io.write_table(roles.raw_times(spark, sf_dir), f"{folder}/glucose.csv", "csv")
    raw = io.read_raw(spark, folder, "glucose").withColumnRenamed("id", "user_id")
    return L.parse_times(raw).select("user_id", F.col("timestamp").cast("timestamp_ntz").alias("ts"), "value_decimal")


@query("s02_pruned_scan", "SELECT p_name AS food_name FROM part")
def pruned(spark, sf_dir):
    return roles.table(spark, sf_dir, "part").select(F.col("p_name").alias("food_name"))


@query("s03_table_sink", "SELECT event_id, user_id, ts, value FROM events")
def sink(spark, sf_dir):
    path = f"{scratch_dir(spark)}/events"
    io.write_series(roles.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), path)
    return io.read_table(spark, path)


@query(
    "s04_reparse",
    f"WITH t AS ({TIMES}) SELECT id, t AS \"timestamp\" FROM t",
)
def reparse(spark, sf_dir):
    out = io.reparse(roles.raw_times(spark, sf_dir), ["timestamp"])
    return out.select("id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query(
    "s05_optional_source",
    PRED + f", w AS (SELECT user_id, {WEIGHT} AS w FROM pred GROUP BY user_id) SELECT meal_id, {r('coalesce(w, 1)')} AS weight,"
    " 1.0::DOUBLE AS weight_without FROM resp LEFT JOIN w USING (user_id)",
)
def optional(spark, sf_dir):
    folder = scratch_dir(spark)
    io.write_table(predictions(spark, sf_dir).select("meal_id", "user_id", "abs_error"), f"{folder}/predictions")
    rows = responses(spark, sf_dir).select("meal_id", "user_id")
    there = io.weights_or_one(spark, rows, f"{folder}/predictions")
    absent = io.weights_or_one(spark, rows.select("meal_id"), f"{folder}/nothing").withColumnRenamed("weight", "weight_without")
    return r6(there.join(absent, "meal_id"), "weight").select("meal_id", "weight", "weight_without")


@query(
    "s07_result_sink",
    PRED + f"SELECT user_id, {r(WEIGHT)} AS weight FROM pred GROUP BY user_id",
)
def results(spark, sf_dir):
    path = f"{scratch_dir(spark)}/weights"
    io.write_table(user_weights(predictions(spark, sf_dir)).select("user_id", "weight"), path)
    return r6(io.read_table(spark, path), "weight")


IID5 = (
    "SELECT vec_id AS id, label, CAST((row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) - 1) % 5 AS INTEGER)"
    " AS partition_id FROM embeddings"
)


@query("s08_read_shard", f"SELECT id, label FROM ({IID5}) WHERE partition_id = 3")
def shard(spark, sf_dir):
    path = f"{scratch_dir(spark)}/clients"
    io.write_table(iid(roles.arrays(spark, sf_dir), ["id"], 5), path, partition_by=["partition_id"])
    return io.read_shard(spark, path, 3).select("id", "label")


SPLIT = (
    "SELECT vec_id AS id, CASE WHEN row_number() OVER (ORDER BY md5('split42:' || vec_id), vec_id)"
    " <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM embeddings"
)


@query("s09_central_split", f"SELECT id FROM ({SPLIT}) WHERE split = 'test'")
def central(spark, sf_dir):
    return io.read_split(split_local(roles.arrays(spark, sf_dir), ["id"], within=()), "test").select("id")


@query(
    "s10_history_json",
    PRED + f"SELECT fold, count(*) AS n, {r('avg(abs_error)')} AS mae FROM pred GROUP BY fold",
)
def history(spark, sf_dir):
    path = f"{scratch_dir(spark)}/history"
    rows = predictions(spark, sf_dir).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"))
    io.append_history(rows, path)
    return r6(spark.read.schema("fold long, n long, mae double").json(path), "mae")


@query(
    "s11_source_profile",
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM events WHERE event_type {c}"
        for n, c in {"readings": "IN ('view', 'click', 'signup')", "meals": "= 'purchase'", "sport": "= 'error'"}.items()
    ),
)
def profile(spark, sf_dir):
    return source_profile(
        {"readings": roles.readings(spark, sf_dir), "meals": roles.meals(spark, sf_dir), "sport": roles.sport(spark, sf_dir)}
    )
