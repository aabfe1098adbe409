"""Top-k and first-n operators.

Top-k per group is ``row_number() <= k`` over a partitioned window: Spark plans it with a
``WindowGroupLimit`` before the shuffle, so each map task forwards at most k rows per group and a
hot group never reaches one task whole. A global top-k is ``orderBy().limit(k)``, planned as
``TakeOrderedAndProject`` (k rows per task, merged on the driver — bounded by k).
Every ordering is made total with explicit tie-breakers so results do not depend on the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_k_per_group(df: DataFrame, group_by, order_by, k: int, rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*group_by).orderBy(*_cols(order_by))
    rn = F.row_number().over(w)
    if rank_col:
        return df.withColumn(rank_col, rn.cast("bigint")).where(F.col(rank_col) <= k)
    return df.withColumn("_rn", rn).where(F.col("_rn") <= k).drop("_rn")


def top_k(df: DataFrame, order_by, k: int) -> DataFrame:
    return df.orderBy(*_cols(order_by)).limit(k)


def first_value_by(df: DataFrame, group_by, value: str, order_by, alias: str | None = None) -> DataFrame:
    """Value of the first row per group in ``order_by`` order, as one combinable aggregate."""
    order = F.struct(*_cols(order_by))
    return df.groupBy(*group_by).agg(F.min_by(F.col(value), order).alias(alias or value))


def first_n_distinct(df: DataFrame, group_by, value: str, n: int, descending: bool = False) -> DataFrame:
    """The first ``n`` distinct values per group in sorted order (a default multi-selection)."""
    v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    d = df.select(*group_by, value).distinct()
    if group_by:
        return top_k_per_group(d, group_by, [v], n)
    return d.orderBy(v).limit(n)


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def distributed_row_number(df: DataFrame, partition_by, buckets, order_by, out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY p ORDER BY o)`` without sending a whole group to one task.

    A window sends every row of a group to one task, and a group here (the drivers of a season) grows
    with the data. Instead a group is cut into ``buckets``: (column name, descending) pairs, non-null columns
    whose order is a coarsening of ``order_by`` (the points, then the head of a name). Rows are counted per
    (group, bucket), combined map-side; a running sum of the counts over a group's buckets gives the
    rows before each; and a window numbers the rows of one bucket. Everything stays lazy, so filters on the
    group reach the scan and unused columns are pruned. ``order_by`` must make the order total.
    """
    part, names = list(partition_by), [n for n, _ in buckets]
    counts = df.groupBy(*part, *names).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(n).desc() if descending else F.col(n).asc() for n, descending in buckets]
    before = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate([*part, *names])],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*part, *names).orderBy(*_cols(order_by))
    numbered = df.withColumn("_rn", F.row_number().over(inside))
    cond = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate([*part, *names])]
    return (numbered.join(offsets, cond).withColumn(out, (F.col("_before") + F.col("_rn")).cast("bigint"))
            .select(*df.columns, out))


def sorted_values(df: DataFrame, group_by, value: str, out: str, descending: bool = False) -> DataFrame:
    """The different values per group with their place in sorted order, nulls last (O6): row order does not
    survive a stored table, a place does. One row per different value reaches the numbering."""
    v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    w = Window.partitionBy(*group_by).orderBy(v) if group_by else Window.orderBy(v)
    return df.select(*group_by, value).distinct().withColumn(out, F.row_number().over(w).cast("bigint"))
