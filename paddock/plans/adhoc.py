"""Guarded ad-hoc SQL over the marts (H1).

The question-answering screens run a generated statement and show either its rows or the error as
text. Here the statement (trimmed, one trailing ';' allowed) is wrapped as a sub-query before Spark
parses it, so only a query can run: DDL, commands and several statements are parse errors. ``guard`` then admits
only listed functions, operators and expressions over the given views: no files, table functions, other tables of the
session or functions that call out of the query. Errors, whether found by analysis or while the query
runs, come back as text. The marts are exposed as temporary views; the result stays a lazy DataFrame:
``answer`` writes all of it to a folder, or prints a bounded number of rows and says when there are more.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from paddock.plans import guard
from paddock.sinks.tables import export_csv

ERROR_PREFIX = "Query failed: "


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def guarded(spark: SparkSession, sql: str, views) -> DataFrame:
    """The query as a lazy DataFrame, over the registered views named in ``views`` and nothing else."""
    text = sql.strip()
    if text.endswith(";"):
        text = text[:-1].rstrip()
    wrapped = f"SELECT * FROM ({text}\n) q"  # the newline keeps a trailing comment from swallowing the parenthesis
    guard.check_parsed(spark, wrapped, views)
    df = spark.sql(wrapped)
    guard.check_analysed(spark, df._jdf.queryExecution().analyzed(), views)
    return df


def _text(e: Exception) -> str:
    return ERROR_PREFIX + next((line.strip() for line in str(e).splitlines() if line.strip()), type(e).__name__)


def run_adhoc(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None):
    """Return ``(DataFrame, None)`` for a valid query or ``(None, error_text)``."""
    register_views(views or {})
    try:
        return guarded(spark, sql, views or {}), None
    except (PySparkException, Py4JJavaError, ValueError) as e:
        return None, _text(e)


def preview(df: DataFrame, n: int = 100) -> str:
    """Text table of at most ``n`` rows for display, with a note when there are more."""
    rows = df.limit(n + 1).toPandas()
    more = f"\n(the first {n} rows; there are more)" if len(rows) > n else ""
    return rows.head(n).to_string(index=False) + more


def answer(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None, n: int = 100,
           output: str | None = None) -> tuple[str, bool]:
    """(text, failed): the rows, or where the whole result was written, or the error."""
    df, err = run_adhoc(spark, sql, views)
    if err:
        return err, True
    try:
        if output is None:
            return preview(df, n), False
        export_csv(df, output)
        return f"written to {output}", False
    except (PySparkException, Py4JJavaError) as e:
        return _text(e), True


def describe(spark: SparkSession, table: str) -> list[str]:
    """Schema as 'column (type)' items (S9), from the built-in DESCRIBE."""
    return [f"{r.col_name} ({r.data_type})" for r in spark.sql(f"DESCRIBE {table}").collect()]
