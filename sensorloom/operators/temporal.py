"""Time joins and windows that never put a whole user into one task.

Every operator splits a series by (keys, time bucket). A user with a large part
of all rows is thus spread over as many groups as the series has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions.columns import bucket_start
from sensorloom.session import durable

CLOSED = ("both", "left", "right", "neither")


def _inside(lts: Column, rts: Column, lo: int, hi: int, closed: str) -> Column:
    if closed not in CLOSED:
        raise ValueError(f"closed must be one of {CLOSED}")
    low = rts >= lts + lo if closed in ("both", "left") else rts > lts + lo
    high = rts <= lts + hi if closed in ("both", "right") else rts < lts + hi
    return low & high


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    lo: int,
    hi: int,
    closed: str = "both",
    left_us: str = "us",
    right_us: str = "r_us",
    width: int | None = None,
    salt: int = 1,
) -> DataFrame:
    """Inner join on equal keys and right time in [left + lo, left + hi].

    Both sides meet in one time bucket: a left row is copied to the buckets its
    interval touches (two at the default width), a right row has one. `salt`
    splits each bucket further by a hash of the right time; AQE's skew join
    splits whatever remains uneven, since both sides of an inner join may split.
    Column names must not clash other than in `on`.
    """
    span = width or max(hi - lo, 1)
    # both sides carry the bucket under one name, so the join is a plain
    # equi-join with the exact range as the residual condition
    lhs = left.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                bucket_start(F.col(left_us) + lo, span),
                bucket_start(F.col(left_us) + hi, span),
                F.lit(span).cast("long"),
            )
        ),
    )
    rhs = right.withColumn("_bucket", bucket_start(right_us, span))
    keys = [*on, "_bucket"]
    if salt > 1:
        lhs = lhs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        rhs = rhs.withColumn("_salt", F.pmod(F.xxhash64(right_us), F.lit(salt)).cast("int"))
        keys.append("_salt")
    joined = lhs.join(rhs, keys).where(_inside(F.col(left_us), F.col(right_us), lo, hi, closed))
    return joined.drop("_bucket", "_salt")


def plain_interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    lo: int,
    hi: int,
    closed: str = "both",
    left_us: str = "us",
    right_us: str = "r_us",
) -> DataFrame:
    """Same result without buckets; for short series and as the test's yardstick."""
    return left.join(right, list(on)).where(_inside(F.col(left_us), F.col(right_us), lo, hi, closed))


def interval_agg(
    left: DataFrame,
    right: DataFrame,
    key: str,
    on: Sequence[str],
    lo: int,
    hi: int,
    aggs: Sequence[Column],
    closed: str = "both",
    having: Column | None = None,
    keep: Sequence[str] = (),
    **join_args,
) -> DataFrame:
    """Aggregate the right rows of each left row's interval, one row per `key`.

    Only the columns the join needs travel with the pairs. The aggregates merge
    map-side before the shuffle on `key`. Left rows without a match are absent.
    """
    slim = left.select(*dict.fromkeys([key, *on, join_args.get("left_us", "us"), *keep]))
    pairs = interval_join(slim, right, on, lo, hi, closed, **join_args)
    out = pairs.groupBy(key).agg(*aggs)
    return out if having is None else out.where(having)


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: str,
    on: Sequence[str],
    tolerance: int,
    value: str,
    name: str,
    tie: str | None = None,
) -> DataFrame:
    """Last right value at or before the left time, within the tolerance."""
    order = F.struct("r_us", tie) if tie else F.col("r_us")
    found = interval_agg(
        left, right, key, on, -tolerance, 0, [F.max_by(value, order).alias(name)]
    )
    return left.join(found, key, "left")


def previous_in_series(
    series: DataFrame,
    on: Sequence[str],
    within: int,
    us: str,
    columns: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Previous row's columns as `prev_*`, null if it is more than a bucket away.

    The row before the first one of a bucket is the last one of the bucket
    before it, if it lies within `within`; that single row is carried over.
    """
    cols = list(dict.fromkeys([us, *columns]))
    tie = list(order)
    base = series.withColumn("_bucket", bucket_start(us, within)).withColumn("_carry", F.lit(False))
    names = series.columns
    last = (
        series.withColumn("_bucket", bucket_start(us, within) + within)
        .groupBy(*on, "_bucket")
        .agg(F.max(F.struct(us, *[c for c in dict.fromkeys(tie + names) if c not in (us, *on)])).alias("_s"))
        .select(*on, *[F.col("_s")[c].alias(c) for c in names if c not in on], "_bucket")
        .withColumn("_carry", F.lit(True))
    )
    w = Window.partitionBy(*on, "_bucket").orderBy(us, *tie)
    both = base.unionByName(last.select(base.columns))
    lagged = both.select(
        "*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in cols]
    ).where(~F.col("_carry"))
    near = F.col(us) - F.col(f"prev_{us}") <= within
    return lagged.select(
        *names, *[F.when(near, F.col(f"prev_{c}")).alias(f"prev_{c}") for c in cols]
    )


CELLS = 4096  # of a rolling window's width


def rolling_moments(
    events: DataFrame,
    series: DataFrame,
    key: str,
    on: Sequence[str],
    width: int,
    values: Sequence[str],
    event_us: str = "us",
    series_us: str = "r_us",
    cells: int = CELLS,
) -> DataFrame:
    """Rows, and n, mean and m2 (squared deviations) of each value, over [t - width, t).

    The axis is cut into blocks of the width, and each block into `cells` cells. t and
    t - width lie at the same place of neighbouring blocks, so a window has four parts:
    the end of the cell of t - width, the cells after it in its block, the cells before
    that of t in the next block, and the start of t's cell. The inner two are running
    moments over cells, of which a block has `cells` at most; the outer two are running
    moments over the rows of one cell. So an event adds two probe rows whatever the data
    are, no pair of event and reading is built, and no task sorts a user's whole window.
    """
    fine = -(-width // cells)
    rows = _probes(events, key, on, width, fine, event_us, values).unionByName(
        series.select(
            *on, *_position(F.col(series_us), width, fine), F.col(series_us).alias("_us"),
            F.lit(None).cast(events.schema[key].dataType).alias("_key"), F.lit(None).cast("string").alias("_part"),
            *[F.col(v).cast("double").alias(v) for v in values],
        )
    )
    place = [*on, "_block", "_cell"]
    cell = Window.partitionBy(*place)
    up = cell.orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    down = cell.orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, 0)
    # of each cell, its moments once, and the probes with theirs; stored, as both are read from here
    found = durable(rows.select(
        *place, "_key", "_part", _moments(values, lambda c: c.over(up)).alias("_up"),
        _moments(values, lambda c: c.over(down)).alias("_down"), _moments(values, lambda c: c.over(cell)).alias("_m"),
        (F.row_number().over(cell.orderBy("_us")) == 1).alias("_one"),
    ).where(F.col("_one") | F.col("_part").isNotNull()))
    inner = _running(found.where("_one").select(*place, "_m"), on, values)
    first = F.col("_part") == "start"
    parts = found.where(F.col("_part").isNotNull()).drop("_m").join(inner, place).select(
        F.col("_key").alias(key),
        F.explode(F.array(F.when(first, F.col("_up")).otherwise(F.col("_down")),
                          F.when(first, F.col("_before")).otherwise(F.col("_after")))).alias("_m"),
    )
    # four parts per event
    merged = parts.groupBy(key).agg(F.collect_list("_m").alias("_p"))
    out = {"n_rows": F.aggregate("_p", F.lit(0).cast("long"), lambda s, p: s + p["rows"])}
    for v in values:
        out[v] = _merge_moments(F.col("_p"), v)
    wide = merged.select(key, *[c.alias(n) for n, c in out.items()])
    return wide.select(
        key, "n_rows", *[F.col(v)[f].alias(f"{v}_{f}") for v in values for f in ("n", "mean", "m2")]
    )


def _position(us: Column, width: int, fine: int) -> list[Column]:
    block = bucket_start(us, width)
    return [block.alias("_block"), F.floor((us - block) / F.lit(fine)).cast("long").alias("_cell")]


def _probes(events: DataFrame, key: str, on: Sequence[str], width: int, fine: int, us: str, values: Sequence[str]) -> DataFrame:
    """Each event twice: at t and at t - width."""
    ends = F.array(
        F.struct(F.lit("start").alias("part"), F.col(us).alias("at")),
        F.struct(F.lit("end").alias("part"), (F.col(us) - width).alias("at")),
    )
    at = F.col("_e")["at"]
    return events.select(*on, key, F.explode(ends).alias("_e")).select(
        *on, *_position(at, width, fine), at.alias("_us"), F.col(key).alias("_key"), F.col("_e")["part"].alias("_part"),
        *[F.lit(None).cast("double").alias(v) for v in values],
    )


def _moments(values: Sequence[str], over) -> Column:
    """Rows, and n, mean and m2 of each value; equal values have exactly their value as mean."""
    fields = [over(F.count(F.when(F.col("_part").isNull(), F.lit(1)))).alias("rows")]
    for v in values:
        n, lo, hi = over(F.count(v)), over(F.min(v)), over(F.max(v))
        mean = F.when(lo == hi, lo).otherwise(over(F.avg(v)))
        fields += [
            n.alias(f"{v}_n"), F.coalesce(mean, F.lit(0.0)).alias(f"{v}_mean"),
            F.coalesce(over(F.var_pop(v)) * n, F.lit(0.0)).alias(f"{v}_m2"), lo.alias(f"{v}_lo"), hi.alias(f"{v}_hi"),
        ]
    return F.struct(*fields)


def _running(cells: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Moments of all cells before and of all cells after each one in its block.

    Sums are taken from the block's least cell mean, so that little is lost in the difference of squares.
    """
    block = Window.partitionBy(*on, "_block")
    based = cells.select(
        *on, "_block", "_cell", "_m",
        *[F.min(F.when(F.col("_m")[f"{v}_n"] > 0, F.col("_m")[f"{v}_mean"])).over(block).alias(f"_base_{v}") for v in values],
    )
    frames = {
        "_before": block.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1),
        # from the other end, since a frame that shrinks is summed anew for each row
        "_after": block.orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1),
    }

    def run(frame) -> Column:
        fields = [F.coalesce(F.sum(F.col("_m")["rows"]).over(frame), F.lit(0)).alias("rows")]
        for v in values:
            count, base = F.col("_m")[f"{v}_n"], F.coalesce(F.col(f"_base_{v}"), F.lit(0.0))
            gap = F.when(count > 0, F.col("_m")[f"{v}_mean"] - base).otherwise(0.0)
            n = F.coalesce(F.sum(count).over(frame), F.lit(0))
            s = F.coalesce(F.sum(count * gap).over(frame), F.lit(0.0))
            q = F.coalesce(F.sum(F.col("_m")[f"{v}_m2"] + count * gap * gap).over(frame), F.lit(0.0))
            lo, hi = F.min(F.col("_m")[f"{v}_lo"]).over(frame), F.max(F.col("_m")[f"{v}_hi"]).over(frame)
            fields += [
                n.alias(f"{v}_n"),
                F.when(lo == hi, lo).otherwise(base + F.coalesce(F.try_divide(s, n), F.lit(0.0))).alias(f"{v}_mean"),
                F.when(lo == hi, 0.0).otherwise(
                    F.greatest(q - F.coalesce(F.try_divide(s * s, n), F.lit(0.0)), F.lit(0.0))
                ).alias(f"{v}_m2"),
                lo.alias(f"{v}_lo"), hi.alias(f"{v}_hi"),
            ]
        return F.struct(*fields)

    return based.select(*on, "_block", "_cell", *[run(f).alias(n) for n, f in frames.items()])


def _merge_moments(parts: Column, v: str) -> Column:
    """Pairwise merge of (n, mean, m2); see Chan, Golub and LeVeque 1979."""

    def step(s: Column, p: Column) -> Column:
        pn = p[f"{v}_n"].cast("double")
        n = s["n"] + pn
        gap = p[f"{v}_mean"] - s["mean"]
        return F.when(pn == 0, s).otherwise(
            F.struct(
                n.alias("n"),
                (s["mean"] + gap * F.try_divide(pn, n)).alias("mean"),
                (s["m2"] + p[f"{v}_m2"] + gap * gap * F.try_divide(s["n"] * pn, n)).alias("m2"),
            )
        )

    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, zero, step)


def spread(name: str) -> Column:
    """Sample standard deviation from merged moments."""
    return F.when(F.col(f"{name}_n") > 1, F.sqrt(F.col(f"{name}_m2") / (F.col(f"{name}_n") - 1)))


def centre(name: str) -> Column:
    return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_mean"))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the smallest by `order`. Merges map-side, so hot keys are fine."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*order)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), ranked).alias("_s"))
        .select(*keys, *[F.col("_s")[c].alias(c) for c in rest])
    )
