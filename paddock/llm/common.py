"""Small helpers that several training-data operators share."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the lineage, so that a
    lost executor costs a re-read of a few files and later plans see the real sizes."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.landed_at = path
    for paths in _watched:
        paths.append(path)
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``landed`` wrote, once everything made from it is written itself."""
    discard_path(df.sparkSession, df.landed_at)


def discard_path(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_watched: list[list[str]] = []


@contextlib.contextmanager
def watched() -> Iterator[list[str]]:
    """Collects the folders that ``landed`` writes inside."""
    _watched.append([])
    try:
        yield _watched[-1]
    finally:
        _watched.pop()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write go as soon as it has ended, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns that name a row by its content: the id (which may be null or repeated) and a text hash.

    Rows that agree in both hold the same text under the same id, so per-row results found under this
    key hold for each of them, and joining back gives every repeated row its result."""
    return [F.col(id_col).alias("key_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key_hash")]


def join_by_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the row key of :func:`row_key`, null ids included; the right side's key columns go."""
    on = left["key_id"].eqNullSafe(right["key_id"]) & (left["key_hash"] == right["key_hash"])
    joined = left.join(right, on, how)
    return joined if how == "left_semi" else joined.drop(right["key_id"], right["key_hash"])


#: In DuckDB SQL: what CRC-32 makes of each of the 256 bytes.
SQL_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def sql_crc32(text: str) -> str:
    """CRC-32 of a text in DuckDB SQL, where ``t`` holds ``SQL_CRC_TABLE``."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({text}))),
        lambda i: CAST('0x' || substring(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])))"""
