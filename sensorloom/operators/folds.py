"""Folds that keep a user in one piece, and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.operators.ranks import group_medians, hash_rank, scalars, wide_medians
from sensorloom.session import durable


def group_folds(df: DataFrame, k: int = 5, user: str = "user_id", fold: str = "fold") -> DataFrame:
    """Fold per row; all rows of a user share it, and folds are even in rows.

    The users are laid out by size and dealt in turns (0..k-1, k-1..0), so that folds
    differ by at most the largest user. Rows without a user are one user.
    """
    counts = df.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    dealt = dealt_folds(counts, k, user, fold).withColumnRenamed(user, "_fold_user")
    return df.join(dealt, F.col(user).eqNullSafe(F.col("_fold_user"))).select(*df.columns, fold)


def dealt_folds(counts: DataFrame, k: int, user: str = "user_id", fold: str = "fold") -> DataFrame:
    """Users of one size share a rank range; inside it they follow a hash order."""
    sizes = counts.groupBy("_n").agg(F.count(F.lit(1)).alias("_u"))
    start = sizes.select(
        "_n", (F.sum("_u").over(Window.orderBy(F.desc("_n"))) - F.col("_u")).alias("_start")
    )
    ranked = hash_rank(counts, [user], "folds", ["_n"], "_rank", "_total")
    turn = F.pmod(F.col("_start") + F.col("_rank") - 1, F.lit(2 * k))
    dealt = F.when(turn < k, turn).otherwise(2 * k - 1 - turn)
    return ranked.join(start, "_n").select(user, dealt.cast("int").alias(fold))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values take the column's exact median."""
    filled = scalars(df, wide_medians(df, columns, "_m_"))
    return filled.withColumns({c: F.coalesce(F.col(c).cast("double"), f"_m_{c}") for c in columns}).drop(
        *[f"_m_{c}" for c in columns]
    )


def impute_median_by_fold(df: DataFrame, columns: Sequence[str], k: int, fold: str = "fold") -> DataFrame:
    """Variant without a view of the test rows: each fold takes the median of the others."""
    out = None
    for i in range(k):
        med = wide_medians(df.where(F.col(fold) != i), columns, "_m_")
        part = scalars(df.where(F.col(fold) == i), med)
        part = part.withColumns({c: F.coalesce(F.col(c).cast("double"), f"_m_{c}") for c in columns}).select(df.columns)
        out = part if out is None else out.unionByName(part)
    return out


def impute_user_median(df: DataFrame, columns: Sequence[str], user: str = "user_id",
                       last: float | None = 0.0) -> DataFrame:
    """User median, then the median of the column so filled, then `last`."""
    med = group_medians(df, [user], columns, "_u_")
    by_user = df.join(med, user, "left").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), f"_u_{c}") for c in columns}
    ).select(df.columns)
    by_user = durable(by_user)  # the second medians read it three times
    filled = scalars(by_user, wide_medians(by_user, columns, "_m_"))
    tail = [] if last is None else [F.lit(last)]
    return filled.withColumns({c: F.coalesce(c, f"_m_{c}", *tail) for c in columns}).select(df.columns)


def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Missing as 0, then (x - mean) / population spread; 0 where there is no spread."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    stats = filled.agg(
        *[F.avg(c).alias(f"_a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns]
    )
    out = scalars(filled, stats)
    return out.withColumns(
        {
            c + suffix: F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_a_{c}")) / F.col(f"_s_{c}")).otherwise(0.0)
            for c in columns
        }
    ).drop(*[f"_a_{c}" for c in columns], *[f"_s_{c}" for c in columns])

