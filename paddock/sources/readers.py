"""Typed readers for landed raw files and seeds.

Every reader takes an explicit ``StructType``; nothing is inferred, so a new landing file cannot
change a column's type silently (the seed loader of the original re-infers types on every load).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions.columns import nan_to_null


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header CSV, comma separated, double-quote escaping (the form ``export_csv`` writes)."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """Newline-delimited JSON as written by an ingestion job (one record per result row)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_seed_races(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.SEED_RACES)


def read_seed_fastest_laps(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_FASTEST_LAPS).withColumn(
        "lap_time_seconds", nan_to_null("lap_time_seconds"))


def read_seed_results(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, schemas.RAW_RESULTS)
    return df.withColumn("position", nan_to_null("position")).withColumn("points", nan_to_null("points"))


def conform(df: DataFrame, schema) -> DataFrame:
    """Select the schema's columns by name with its types (bind by name, never by position)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
