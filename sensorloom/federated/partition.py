"""Splitting a labelled table over clients. Every rule is a function of the row's
id, the settings and the seed, so the same rows land with the same client on any
layout of the data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.operators.ranks import hash_rank
from sensorloom.session import durable


def iid(df: DataFrame, ids: Sequence[str], k: int, seed: int = 42, out: str = "partition_id") -> DataFrame:
    """Equal shares in hash order."""
    ranked = hash_rank(df, ids, seed, (), "_rank", "_total")
    return ranked.select(*df.columns, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int").alias(out))


def label_owners(df: DataFrame, label: str, k: int, classes: int) -> DataFrame:
    """Clients of each label: client i takes `classes` labels in a row, from i * classes on."""
    labels = df.select(label).distinct()  # one row per class
    placed = labels.select(
        label,
        (F.row_number().over(Window.orderBy(label)) - 1).alias("_i"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("_m"),
    )
    clients = F.sequence(F.lit(0), F.lit(k - 1))
    owns = F.filter(
        clients, lambda c: F.pmod(F.col("_i") - F.pmod(c * classes, F.col("_m")), F.col("_m")) < classes
    )
    return placed.select(label, owns.alias("_owners"))


def pathological(df: DataFrame, ids: Sequence[str], label: str, k: int, classes: int = 2, seed: int = 42,
                 out: str = "partition_id") -> DataFrame:
    """Each client sees `classes` labels; a label's rows are dealt to its owners in turn.

    Rows of a label nobody owns (k * classes below the number of labels) get no client.
    """
    owners = label_owners(df, label, k, classes)
    ranked = hash_rank(df, ids, seed, [label], "_rank", "_total").join(owners, label)
    n = F.size("_owners")
    turn = F.pmod(F.col("_rank") - 1, F.greatest(n, F.lit(1))).cast("int")
    return ranked.select(*df.columns, F.when(n > 0, F.get("_owners", turn)).alias(out))


TRIES = 16  # candidates of a gamma variate; the first good one counts, and all fail once in 1e20 or so


def uniform(*parts) -> Column:
    """A number in (0, 1) from a digest of `parts`."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296


def gamma(alpha: float, *parts) -> Column:
    """Gamma variate of shape `alpha`, a function of `parts` alone; see Marsaglia and Tsang 2000."""
    d = alpha + 2 / 3
    c = 1 / math.sqrt(9 * d)

    def candidate(t: Column) -> Column:
        of = [*parts, t.cast("string")]
        x = F.sqrt(-2 * F.log(uniform(*of, "a"))) * F.cos(2 * math.pi * uniform(*of, "b"))
        v = F.pow(1 + c * x, F.lit(3.0))
        good = (v > 0) & (F.log(uniform(*of, "c")) < 0.5 * x * x + d - d * v + d * F.log(v))
        return F.when(good, d * v)

    found = F.filter(F.transform(F.sequence(F.lit(1), F.lit(TRIES)), candidate), lambda v: v.isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.lit(d)) * F.pow(uniform(*parts, "d"), F.lit(1 / alpha))


def dirichlet_ends(df: DataFrame, label: str, k: int, alpha: float, seed: int, balance: bool) -> DataFrame:
    """(label, last row of each client, clients' sizes in the end): Dirichlet shares of each label over the clients.

    Labels are gone through in sorted order, as one fold over an array of labels * clients numbers. `balance` gives
    nothing of a label to clients that have their even part already.
    """
    name = F.coalesce(F.col(label).cast("string"), F.lit("null"))
    counts = df.groupBy(label).agg(F.count("*").alias("n"))  # one row per class
    drawn = counts.select(
        F.col(label).alias("label"), "n",
        F.array(*[gamma(alpha, "dirichlet", seed, name, c) for c in range(k)]).alias("g"),
    )
    listed = drawn.agg(
        F.array_sort(F.collect_list(F.struct("label", "n", "g"))).alias("all"), (F.sum("n") / k).alias("even")
    )

    def one(state: Column, e: Column) -> Column:
        open_g = F.zip_with(state["sizes"], e["g"], lambda s, g: F.when(F.lit(not balance) | (s < F.col("even")), g).otherwise(0.0))
        upto = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.aggregate(F.slice(open_g, 1, i), F.lit(0.0), lambda a, x: a + x))
        whole = F.element_at(upto, -1)
        share = F.transform(upto, lambda u, i: F.when(whole > 0, u / whole).otherwise((i + 1) / k))
        ends = F.transform(share, lambda u, i: F.when(i == k - 1, e["n"]).otherwise(F.floor(u * e["n"] + 1e-9)).cast("long"))
        taken = F.transform(ends, lambda x, i: x - F.coalesce(F.get(ends, i - 1), F.lit(0)))
        return F.struct(
            F.zip_with(state["sizes"], taken, lambda s, t: s + t).alias("sizes"),
            F.concat(state["out"], F.array(F.struct(e["label"].alias("label"), ends.alias("ends")))).alias("out"),
        )

    kind = df.schema[label].dataType.simpleString()
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), k).alias("sizes"),
        F.array().cast(f"array<struct<label:{kind},ends:array<bigint>>>").alias("out"),
    )
    done = durable(listed.select(F.aggregate("all", start, one).alias("s")))
    return done.select(F.explode("s.out").alias("o"), F.col("s.sizes").alias("sizes")).select("o.label", "o.ends", "sizes")


def moves(sizes: Sequence[int], least: int) -> tuple[list[int], list[int]]:
    """Rows that each client gives, and takes, so that all have `least` where there are enough rows."""
    need = [max(0, least - s) for s in sizes]
    spare = [max(0, s - least) for s in sizes]
    total = min(sum(need), sum(spare))
    give, before = [], 0
    for upto in accumulate(spare):
        now = total * upto // max(sum(spare), 1)
        give.append(now - before)
        before = now
    take, left = [], total
    for n in need:
        take.append(min(n, left))
        left -= take[-1]
    return give, take


def dirichlet(df: DataFrame, ids: Sequence[str], label: str, k: int, alpha: float = 0.5, seed: int = 42,
              least: int = 0, balance: bool = False, out: str = "partition_id") -> DataFrame:
    """Label skew: each label is cut by Dirichlet shares over the clients.

    Clients with fewer than `least` rows get some of those with more, each of which gives in proportion to what it has
    over. Rows without a label are a label of their own.
    """
    table = dirichlet_ends(df, label, k, alpha, seed, balance).withColumnRenamed("label", "_label")
    ranked = hash_rank(df, ids, seed, [label], "_rank", "_total").join(table, F.col(label).eqNullSafe(F.col("_label")))
    # the client is the number of those whose last row comes before this one
    client = F.size(F.filter("ends", lambda e: e < F.col("_rank"))).cast("int")
    dealt = ranked.select(*df.columns, client.alias(out))
    first = table.first()  # `k` sizes
    if first is None or min(first.sizes) >= least:
        return dealt
    give, take = moves(first.sizes, least)
    numbered = hash_rank(dealt, ids, f"{seed}:move", [out], "_rank", "_total")

    def of(values: Sequence[int]) -> Column:
        return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col(out))

    gone = F.col("_rank") - (F.col("_total") - of(give))  # 1-based among those a client gives
    place = of([sum(give[:c]) for c in range(k)]) + gone
    upto = F.array(*[F.lit(int(v)).cast("long") for v in accumulate(take)])
    taker = F.size(F.filter(upto, lambda u: u < place)).cast("int")
    return numbered.select(*[F.when(gone > 0, taker).otherwise(F.col(out)).alias(out) if c == out else F.col(c) for c in dealt.columns])


def assign(df: DataFrame, ids: Sequence[str], label: str, spec: dict, seed: int = 42) -> DataFrame:
    """Partition by an experiment's settings."""
    kind, k = spec["kind"], spec["clients"]
    if kind == "iid":
        return iid(df, ids, k, seed)
    if kind == "dirichlet":
        return dirichlet(
            df, ids, label, k, spec.get("alpha", 0.5), seed, spec.get("least", 0), spec.get("balance", False)
        )
    if kind == "pathological":
        return pathological(df, ids, label, k, spec.get("classes", 2), seed)
    raise ValueError(f"unknown partitioning {kind}")


def split_local(df: DataFrame, ids: Sequence[str], test_share: float = 0.2, seed: int = 42,
                within: Sequence[str] = ("partition_id",), out: str = "split") -> DataFrame:
    """'test' for the first ceil(share * n) rows of each part in hash order, else 'train'."""
    ranked = hash_rank(df, ids, f"split{seed}", within, "_rank", "_total")
    test = F.col("_rank") <= F.ceil(F.lit(test_share) * F.col("_total"))
    return ranked.select(*df.columns, F.when(test, "test").otherwise("train").alias(out))
