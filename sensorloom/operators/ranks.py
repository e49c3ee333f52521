"""Row numbers and exact quantiles without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.session import durable


def hash_key(seed: int | str, *ids: Column | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i) if isinstance(i, str) else i for i in ids]))


def hash_rank(
    df: DataFrame,
    ids: Sequence[str],
    seed: int | str,
    within: Sequence[str] = (),
    rank: str = "rank",
    total: str = "total",
    digits: int = 3,
) -> DataFrame:
    """1-based position in hash order inside each `within` group, and the group size.

    Equal to row_number over (partition by within order by hash, ids), but sorted
    in 16^digits hash ranges per group: the ranges are even whatever the group
    sizes are, and each gets the count of the ranges before it.
    """
    keyed = df.withColumn("_hkey", hash_key(seed, *ids)).withColumn("_hp", F.substring("_hkey", 1, digits))
    group = [*within, "_hp"]
    counts = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("_hn"))
    # at most 16^digits rows per group from here on
    by_range = Window.partitionBy(*within).orderBy("_hp") if within else Window.orderBy("_hp")
    whole = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    starts = counts.select(
        *group,
        (F.sum("_hn").over(by_range) - F.col("_hn")).alias("_hstart"),
        F.sum("_hn").over(whole).alias(total),
    )
    starts = starts.withColumnsRenamed({c: f"_s_{c}" for c in group})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in group])  # a null group keeps its rows
    local = Window.partitionBy(*group).orderBy("_hkey", *ids)
    return (
        keyed.withColumn("_hrn", F.row_number().over(local))
        .join(starts, same)
        .withColumn(rank, F.col("_hstart") + F.col("_hrn"))
        .drop("_hkey", "_hp", "_hrn", "_hstart")
        .select(*df.columns, rank, total)
    )


def hash_sample(df: DataFrame, ids: Sequence[str], n: int, seed: int | str) -> DataFrame:
    """n rows, the same ones on any layout of the data."""
    return df.orderBy(hash_key(seed, *ids), *ids).limit(n)


SKETCH = 1024  # values a sketch keeps before it thins them out: up to so many, its quantiles are exact
SLACK = 0.01  # a bracket's half width in ranks over n; a few times the sketch's error
SORTED = 1_000_000  # distinct values of a bracket that one window may sort
BINS = 1024


def _place(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of a value, 0-based."""
    at = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
    return F.when(hi > lo, at).otherwise(F.lit(0)).cast("long")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Sequence[float],
    group: Sequence[str] = (),
    sketch: int = SKETCH,
    slack: float = SLACK,
    most: int = SORTED,
) -> DataFrame:
    """Exact quantiles (linear interpolation) of many columns, per group.

    Rows: group, feature, q, n, value. The first scan makes a sketch of each column and group. Groups of up to `sketch` values
    are small enough to be held, and take their quantiles directly. For larger ones the sketch gives a bracket around each
    wanted rank; the second scan counts the values below the bracket and shuffles those inside only, merged to counts of
    distinct values. A bracket that misses its rank is taken anew without ends. Brackets with more than `most` distinct values
    are cut into bins until the one that holds the rank has fewer, so no task sorts more. Rows with a null group are left out.
    """
    cols, ids = list(columns), [*group, "_f"]
    doubles = [F.col(c).cast("double") for c in cols]
    shares = F.array(*[F.lit(float(q)) for q in quantiles])
    # rank k of n lies within 1 / n of its share, which is far less than the slack where brackets are used
    bounds = F.array(*[F.lit(min(max(q + d, 0.0), 1.0)) for q in quantiles for d in (-slack, slack)])
    known = df.where(reduce(and_, [F.col(g).isNotNull() for g in group])) if group else df
    sketches = F.array(*[F.struct(F.count(c).alias("n"), F.kll_sketch_agg_double(c, F.lit(sketch)).alias("s")) for c in doubles])
    stats = durable(known.groupBy(*group).agg(sketches.alias("_all")))
    is_large = F.exists("_all", lambda a: a["n"] > sketch)
    any_large = not stats.where(is_large).isEmpty()
    names = F.array(*[F.lit(c) for c in cols])

    held = known
    if any_large:
        held = known.join(stats.where(~is_large).select(*group), list(group), "left_semi") if group else known.limit(0)
    direct = held.groupBy(*group).agg(
        F.array(*[F.struct(F.count(c).alias("n"), F.percentile(c, shares).alias("p")) for c in doubles]).alias("_all")
    )
    out = direct.select(*group, F.posexplode("_all").alias("_f", "_a")).where(F.col("_a")["n"] > 0).select(
        *group, F.get(names, F.col("_f")).alias("feature"), F.col("_a")["n"].alias("n"),
        F.explode(F.arrays_zip(shares.alias("q"), F.col("_a")["p"].alias("value"))).alias("_p"),
    ).select(*group, "feature", F.col("_p")["q"].alias("q"), "n", F.col("_p")["value"].alias("value"))
    if not any_large:
        return out

    pos = F.col("q") * (F.col("n") - 1)
    large = stats.where(is_large).select(*group, F.posexplode("_all").alias("_f", "_a")).select(*ids, "_a.*").where(F.col("n") > 0)
    # the bracket of a column with few values in such a group is open
    bracket = F.when(F.col("n") > sketch, F.kll_sketch_get_quantile_double("s", bounds))
    asked = large.select(*ids, "n", bracket.alias("_b"), F.posexplode(shares).alias("i", "q"))
    ends = F.array(F.struct(F.lit(0).alias("e"), F.floor(pos).alias("k")), F.struct(F.lit(1).alias("e"), F.ceil(pos).alias("k")))
    targets = asked.select(*ids, "n", "i", "q", "_b", F.explode(ends).alias("_e")).select(
        *ids, (F.col("i") * 2 + F.col("_e")["e"]).alias("_t"), "n", "q", F.col("_e")["k"].alias("_k"),
        F.coalesce(F.get("_b", F.col("i") * 2), F.lit(float("-inf"))).alias("_lo"),
        F.coalesce(F.get("_b", F.col("i") * 2 + 1), F.lit(float("inf"))).alias("_hi"),
    )
    targets = durable(targets)
    # without a group there are two targets per column and quantile at most: a bound the data cannot move
    small = (lambda d: d) if group else F.broadcast
    rows = known.join(stats.where(is_large).select(*group), list(group), "left_semi") if group else known
    flat = rows.select(*group, F.posexplode(F.array(*doubles)).alias("_f", "v")).where(F.col("v").isNotNull())

    def inside(targets: DataFrame) -> DataFrame:
        """Counts of the values in each bracket, and of all below it (v null)."""
        met = flat.join(small(targets.select(*ids, "_t", "_lo", "_hi")), ids).where(F.col("v") <= F.col("_hi"))
        return durable(met.groupBy(*ids, "_t", F.when(F.col("v") >= F.col("_lo"), F.col("v")).alias("v")).agg(F.count("*").alias("_n")))

    path = [*ids, "_t"]
    counts = inside(targets)
    met = counts.groupBy(*path).agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("_n"))), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("_n"))), F.lit(0)).alias("_inside"),
        F.count("v").alias("_distinct"),
    )
    targets = targets.join(small(met), path, "left")
    rank = F.col("_k") - F.col("_below")
    missed = F.coalesce((rank < 0) | (rank >= F.col("_inside")), F.lit(True))
    worst = targets.agg(F.count_if(missed).alias("missed"), F.max("_distinct").alias("most")).first()
    cells = counts.where(F.col("v").isNotNull()).withColumn("_cell", F.lit(0).cast("long"))
    placed = targets.where(~missed).select(*path, "n", "q", "_k", rank.alias("_rank"), F.lit(0).cast("long").alias("_cell"))
    widest = worst.most or 0
    if worst.missed:
        again = targets.where(missed).select(*path, "n", "q", "_k", F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"))
        again = durable(again)
        wide = inside(again).withColumn("_cell", F.lit(0).cast("long"))
        cells = cells.join(small(again.select(*path)), path, "left_anti").unionByName(wide)
        placed = placed.unionByName(again.select(*path, "n", "q", "_k", F.col("_k").alias("_rank"), F.lit(0).cast("long").alias("_cell")))
        widest = max(widest, wide.groupBy(*path).count().agg(F.max("count")).first()[0])

    path = [*path, "_cell"]
    while widest > most:
        edges = cells.groupBy(*path).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
        binned = cells.join(small(edges), path).withColumn("_bin", _place(F.col("v"), F.col("_lo"), F.col("_hi"), BINS))
        run = Window.partitionBy(*path).orderBy("_bin")
        hist = binned.groupBy(*path, "_bin").agg(F.sum("_n").alias("_size")).select(
            *path, "_bin", F.sum("_size").over(run).alias("_upto"), "_size"
        )
        before = F.col("_upto") - F.col("_size")
        hit = (F.col("_rank") >= before) & (F.col("_rank") < F.col("_upto"))
        placed = durable(small(placed).join(hist, path).where(hit).select(*path, "n", "q", "_k", (F.col("_rank") - before).alias("_rank"), "_bin"))
        cells = durable(binned.join(small(placed.select(*path, "_bin")), [*path, "_bin"], "left_semi").select(
            *path[:-1], (F.col("_cell") * BINS + F.col("_bin")).alias("_cell"), "v", "_n"
        ))
        placed = placed.select(*path[:-1], "n", "q", "_k", "_rank", (F.col("_cell") * BINS + F.col("_bin")).alias("_cell"))
        widest = cells.groupBy(*path).count().agg(F.max("count")).first()[0]

    run = Window.partitionBy(*path).orderBy("v")
    ranked = cells.select(*path, "v", F.sum("_n").over(run).alias("_upto"), F.col("_n").alias("_size"))
    hit = (F.col("_rank") >= F.col("_upto") - F.col("_size")) & (F.col("_rank") < F.col("_upto"))
    found = small(placed).join(ranked, path).where(hit)
    both = found.groupBy(*ids, "q").agg(F.first("n").alias("n"), F.min_by("v", "_t").alias("_v0"), F.max_by("v", "_t").alias("_v1"))
    value = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (pos - F.floor(pos))
    return out.unionByName(both.select(*group, F.get(names, F.col("_f")).alias("feature"), "q", "n", value.alias("value")))


def wide_medians(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """One row with the exact median of each column."""
    q = exact_quantiles(df, columns, [0.5])
    return q.agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(prefix + c) for c in columns])


def group_medians(df: DataFrame, group: Sequence[str], columns: Sequence[str], prefix: str = "") -> DataFrame:
    """One row per group with the exact median of each column."""
    q = exact_quantiles(df, columns, [0.5], group)
    return q.groupBy(*group).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(prefix + c) for c in columns]
    )


def scalars(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Put the columns of a one-row table on every row, as scalar subqueries."""
    row = stats.select(F.struct(*stats.columns).alias("_row")).scalar()
    return df.select("*", row.alias("_row")).select(
        *df.columns, *[F.col("_row")[c].alias(c) for c in stats.columns]
    )


def ordered_rank(df: DataFrame, *order: Column | str, rank: str = "rank") -> DataFrame:
    """1-based position in a total order, without a sort in one task.

    The partitions of a range-partitioned sort hold consecutive rows; each begins after the rows of those before it.
    """
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = durable(cut.select("*", F.monotonically_increasing_id().alias("_at")))  # partition and row in it
    part = F.shiftright("_at", 33)
    sizes = sorted(cut.groupBy(part.alias("p")).count().collect())  # one row per partition
    begins, before = [], 0
    for r in sizes:
        begins.append((r.p, before))
        before += r["count"]
    begins = df.sparkSession.createDataFrame(begins, "_part long, _before long")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return cut.withColumn("_part", part).join(F.broadcast(begins), "_part").select(
        *df.columns, (F.col("_before") + inside + 1).alias(rank)
    )


def label_codes(df: DataFrame, column: str, code: str, missing: str = "unknown") -> DataFrame:
    """Code of each label by its place in sorted order; null counts as `missing`.

    Only the distinct labels are ranked; they merge map-side first. Adaptive execution
    broadcasts them by their measured size, or splits a label with most rows.
    """
    filled = df.withColumn("_label", F.coalesce(F.col(column).cast("string"), F.lit(missing)))
    codes = ordered_rank(filled.select("_label").distinct(), "_label").select("_label", (F.col("rank") - 1).cast("int").alias(code))
    return filled.join(codes, "_label").drop("_label")
