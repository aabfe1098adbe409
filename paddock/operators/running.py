"""Running sum (``SUM() OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING..CURRENT ROW)``)
that survives a hot partition key.

A plain window sends every row of one partition key to one task; if one driver or user holds a third
of all rows, that task holds a third of the data. Here the sum is split in two levels:

1. ``chunk`` is a coarse column that is monotone in the order (the leading order column or a bucket
   of it: the round of a result, the hour of an event; null with it). The rows of one (key, chunk)
   are summed by a window partitioned by key *and* chunk, so a hot key is spread over its chunks.
2. Per (key, chunk) totals get an exclusive prefix sum over the chunks of the key. That window sees at most
   #chunks rows per key (bounded by the calendar).
3. An equi-join on (key, chunk) adds the offset to the in-chunk sum.

The rows are repartitioned on (key, chunk) once: the window and the totals both read that exchange, and the detail side of
the join keeps its partitioning, so the input is computed once and crosses one exchange (``same_columns``).
Callers select the columns they need first; if a later step drops some of them, the two sides are planned apart.

Null partition keys form their own group (as in SQL) and null order values come last, as a chunk of
their own: both are joined through a coalesced value plus an is-null flag, so the equi-join stays a
plain hash/sort-merge join and no row is lost.
Exact for integral and DECIMAL values; sum DOUBLE fractions through DECIMAL (T6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _default_for(dt):
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.DateType,)):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dt)


def same_columns(df: DataFrame, keys, *aggregates) -> DataFrame:
    """``df`` grouped by ``keys``, by an aggregate that also reads every column of ``df`` (their hash is never null), so that
    the optimizer cannot cut columns below an exchange that another branch of the plan reads whole: the
    branches then share it."""
    whole = F.max(F.xxhash64(*df.columns)).alias("_whole")
    return df.groupBy(*keys).agg(whole, *aggregates).where("_whole IS NOT NULL").drop("_whole")


def running_sum(df: DataFrame, partition_by, order_by, value: str, out: str, chunk: str | Column | None = None) -> DataFrame:
    """Add column ``out`` = running sum of ``value`` per ``partition_by`` in ``order_by`` order.

    ``order_by`` is a list of column names or Columns; its first element must be ``chunk`` (or a
    column that ``chunk`` is a monotone bucket of); names are ordered ascending, nulls last. With ``chunk=None`` a single window is used.
    An expression as ``chunk`` is no column of the result.
    """
    part = list(partition_by)
    orders = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    if chunk is None:
        w = Window.partitionBy(*part).orderBy(*orders).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(w))

    names = [*part, chunk]
    if isinstance(chunk, Column):
        df, names[-1] = df.withColumn("_chunk", chunk), "_chunk"
    types = {f.name: f.dataType for f in df.schema.fields}
    keys = []
    for i, c in enumerate(names):
        df = (df.withColumn(f"_rk{i}", F.coalesce(F.col(c), _default_for(types[c])))
              .withColumn(f"_rn{i}", F.col(c).isNull()))
        keys += [f"_rk{i}", f"_rn{i}"]
    group, (in_chunk, no_chunk) = keys[:-2], keys[-2:]

    df = (df.drop("_chunk") if isinstance(chunk, Column) else df).repartition(*keys)
    w_in = Window.partitionBy(*keys).orderBy(*orders).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    detail = df.withColumn("_in_chunk", F.sum(value).over(w_in))

    totals = same_columns(df, keys, F.sum(value).alias("_chunk_sum"))
    w_prev = (Window.partitionBy(*group).orderBy(F.col(no_chunk), F.col(in_chunk))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, F.sum("_chunk_sum").over(w_prev).alias("_offset"))

    # a sum over nulls only stays null, as in SQL
    whole = F.when(F.col("_offset").isNull(), F.col("_in_chunk")).otherwise(F.col("_offset") + F.coalesce("_in_chunk", F.lit(0)))
    return detail.join(offsets, keys).withColumn(out, whole).drop("_offset", "_in_chunk", *keys)
