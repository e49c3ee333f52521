"""Local training and example-weighted averaging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.federated.partition import split_local
from sensorloom.functions.columns import normalise
from sensorloom.session import durable
SALTS = 16  # parts of a client in a join


def weighted_mean(params: DataFrame, by: Sequence[str] = ("block",), values: str = "values",
                  weight: str = "n_examples") -> DataFrame:
    """Mean of parameter arrays, element by element, weighted by examples."""
    items = params.select(*by, F.col(weight).alias("_w"), F.posexplode(values).alias("_i", "_v"))
    mean = items.groupBy(*by, "_i").agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias("_m"))
    # as many rows per block as the block has parameters
    rows = F.array_sort(F.collect_list(F.struct("_i", "_m")))
    return mean.groupBy(*by).agg(F.transform(rows, lambda x: x["_m"]).alias(values))


def weighted_metrics(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = (),
                     weight: str = "n_examples") -> DataFrame:
    w = F.col(weight)
    return df.groupBy(*by).agg(*[(F.sum(F.col(m) * w) / F.sum(w)).alias(m) for m in metrics])


def _gradients(rows: DataFrame, weights: DataFrame, classes: int, width: int, keys: Sequence[str]) -> DataFrame:
    """Per client: gradient of its mean loss (flat, class by class) and the loss.

    A row's part of a class's gradient is its error in that class times its features. A client's rows meet its weights in
    `SALTS` parts, whose sums are merged: no task holds a client whole.
    """
    parted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    weights = weights.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    z = parted.join(weights, [*keys, "_salt"]).withColumn("_z", _logits(F.col("x"), F.col("_w"), classes, width))
    top = F.array_max("_z")
    z = z.withColumn("_log_sum", top + F.log(F.aggregate("_z", F.lit(0.0), lambda s, v: s + F.exp(v - top))))
    error = F.transform("_z", lambda v, c: F.exp(v - F.col("_log_sum")) - (c == F.col("label")).cast("double"))
    loss = F.col("_log_sum") - F.get("_z", F.col("label"))
    each = z.select(*keys, "x", loss.alias("_loss"), F.posexplode(error).alias("_class", "_error"))
    means = [F.avg(F.col("_error") * F.get("x", F.lit(i))) for i in range(width)]
    by_class = each.groupBy(*keys, "_class").agg(
        F.array(*means, F.avg("_error")).alias("_g"), F.avg("_loss").alias("_loss")
    )
    whole = F.transform(F.array_sort(F.collect_list(F.struct("_class", "_g"))), lambda s: s["_g"])  # one per class
    return by_class.groupBy(*keys).agg(F.flatten(whole).alias("_g"), F.max("_loss").alias("_loss"))


def local_training(rows: DataFrame, start: DataFrame, classes: int, width: int, rate: float, epochs: int,
                   momentum: float, keys: Sequence[str] = ("experiment", "partition_id"),
                   on: Sequence[str] = ("experiment",)) -> DataFrame:
    """Softmax regression of every client on its own rows (x, label), from the parameters in `start` (flat `values`).

    One gradient step on all of a client's rows per epoch, the same at any size of a client. Comes back as blocks, the
    loss being one of them, so that one weighted mean serves both. Rows without features or without one of the classes
    as their label are left out; a client without rows has no blocks.
    """
    known = F.col("x").isNotNull() & F.col("label").between(0, classes - 1)
    rows = rows.where(known).select(*keys, "x", F.col("label").cast("int").alias("label"))
    zeros = F.array_repeat(F.lit(0.0), classes * (width + 1))
    state = (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_examples"))
        .join(start.select(*on, F.col("values").alias("_w")), list(on))
        .select(*keys, "n_examples", "_w", zeros.alias("_speed"), F.lit(0.0).alias("_total"))
    )  # one row per client
    for _ in range(epochs):
        state = durable(state)
        step = state.join(_gradients(rows, state.select(*keys, "_w"), classes, width, keys), list(keys))
        step = step.withColumn("_speed", F.zip_with("_speed", "_g", lambda v, g: v * momentum + g))
        state = step.select(
            *keys, "n_examples", F.zip_with("_w", "_speed", lambda w, v: w - v * rate).alias("_w"), "_speed",
            (F.col("_total") + F.col("_loss")).alias("_total"),
        )
    blocks = F.array(
        F.struct(F.lit("linear").alias("block"), F.col("_w").alias("values")),
        F.struct(F.lit("train_loss").alias("block"), F.array(F.col("_total") / max(epochs, 1)).alias("values")),
    )
    return state.select(*keys, F.inline(blocks), "n_examples")


def _logits(x: Column, w: Column, classes: int, width: int) -> Column:
    """Dot products with the classes' slices of the flat parameter array."""

    def dot(c: Column) -> Column:
        row = F.slice(w, c * (width + 1) + 1, F.lit(width + 1))
        products = F.zip_with(F.concat(x, F.array(F.lit(1.0))), row, lambda a, b: a * b)
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), dot)


def evaluate(rows: DataFrame, params: DataFrame, classes: int, width: int, by: Sequence[str],
             on: Sequence[str] = ("experiment",)) -> DataFrame:
    """Mean loss and accuracy of `rows` (x, label) per key, on the JVM."""
    scored = rows.join(F.broadcast(params.select(*on, F.col("values").alias("_w"))), list(on))
    z = scored.withColumn("_z", _logits(F.col("x"), F.col("_w"), classes, width))
    top = F.array_max("_z")
    log_sum = top + F.log(F.aggregate("_z", F.lit(0.0), lambda s, v: s + F.exp(v - top)))
    loss = log_sum - F.get("_z", F.col("label"))
    hit = (F.array_position("_z", top) - 1 == F.col("label")).cast("double")
    return z.groupBy(*by).agg(
        F.avg(loss).alias("loss"), F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_examples")
    )


def prepare_clients(assigned: DataFrame, ids: Sequence[str], features: str, label: str) -> DataFrame:
    """Normalised features and local split per row, stored, as every epoch reads them."""
    keys = ["experiment", "partition_id"]
    rows = assigned.where(F.col("partition_id").isNotNull()).select(
        *ids, *keys, normalise(features).alias("x"), F.col(label).cast("int").alias("label")
    )
    return durable(split_local(rows, ids, within=keys))


def summary(history: DataFrame, specs: Sequence[dict], rounds: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """Accuracy at some rounds, loss at the last, and the gap of few to many clients."""
    last = rounds[-1]
    wide = history.groupBy("experiment").agg(
        *[F.max(F.when(F.col("round") == n, F.col("accuracy"))).alias(f"acc_r{n}") for n in rounds],
        F.max(F.when(F.col("round") == last, F.col("loss"))).alias(f"loss_r{last}"),
    )
    spark = history.sparkSession
    kinds = spark.createDataFrame(
        [(s["name"], s["kind"], s["clients"]) for s in specs], "experiment string, kind string, clients int"
    )
    rows = wide.join(F.broadcast(kinds), "experiment")
    ends = rows.groupBy("kind").agg(
        (F.min_by(f"acc_r{last}", "clients") - F.max_by(f"acc_r{last}", "clients")).alias("gap_few_many")
    )
    return rows.join(ends, "kind")


