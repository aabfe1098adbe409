"""Lookup with default (J5): left join to a small dimension, then ``coalesce`` with the default.

The dimension is one row per key (a colour table, a calendar); Spark broadcasts it when AQE measures
it under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join otherwise, so
no unchecked broadcast hint is needed. Duplicated dimension keys are collapsed first (first value by
key order) so the lookup can never multiply fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_with_default(df: DataFrame, key: str, dim: DataFrame, dim_key: str, value: str, default,
                        out: str | None = None) -> DataFrame:
    one = dim.groupBy(F.col(dim_key).alias("_lk")).agg(F.min(value).alias("_lv"))
    return (df.join(one, F.col(key) == F.col("_lk"), "left")
            .withColumn(out or value, F.coalesce(F.col("_lv"), F.lit(default)))
            .drop("_lk", "_lv"))
