"""Data-quality expectations (E1-E4). A test is a query that returns its violations; zero = pass.

- ``not_null_counts``: every not-null test of one table in one aggregate pass; ``null_counters`` are the same counts
  for the job that writes the table, which then needs no pass of its own (``known`` of ``report``).
- ``unique_combination``: violating groups with ``row_count`` (``HAVING count(*) > 1``); partial
  aggregation combines map-side, so a hot key costs one row per task.
- ``relationship``: child rows whose value is missing from the parent (a left anti join; the parent
  side is one row per key after ``distinct``).
- ``report`` / ``assert_passed``: one row per test with its violation count; raise when any fails.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marts' tests, (table, column) pairs that must not be null, and the unique combination.
NOT_NULL_TESTS = (
    ("driver_standings", "driver_code"),
    ("driver_standings", "season_year"),
    ("driver_standings", "total_points"),
    ("driver_standings", "championship_position"),
    ("team_performance", "team_name"),
    ("team_performance", "season_year"),
    ("team_performance", "total_points"),
    ("fastest_laps_enriched", "driver_code"),
    ("fastest_laps_enriched", "lap_time_seconds"),
)
UNIQUE_TESTS = (("driver_standings", ("season_year", "championship_position")),)


class ExpectationFailed(AssertionError):
    pass


def not_null_counts(df: DataFrame, table: str, columns) -> DataFrame:
    """One row per column: (test_name, table_name, column_name, violations), from one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_v{i}") for i, c in enumerate(columns)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"_v{i}").alias("violations"))
             for i, c in enumerate(columns)]
    return (agg.select(F.explode(F.array(*pairs)).alias("t"))
            .select(F.lit("not_null").alias("test_name"), F.lit(table).alias("table_name"),
                    F.col("t.column_name").alias("column_name"), F.col("t.violations").alias("violations")))


def null_counters(table: str, not_null=NOT_NULL_TESTS) -> dict[str, Column]:
    """The violations of a table's not-null tests as aggregates that a write can observe, by column."""
    return {c: F.count_if(F.col(c).isNull()) for t, c in not_null if t == table}


def unique_combination(df: DataFrame, columns) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values (non-null) that the parent lacks, one row per violating child row."""
    keys = parent.select(F.col(field).alias("_to")).distinct()
    return (child.select(F.col(column).alias("from_field")).where(F.col("from_field").isNotNull())
            .join(keys, F.col("from_field") == F.col("_to"), "left_anti"))


def round_fits_key(df: DataFrame, round_col: str = "round", max_round: int = 99) -> DataFrame:
    """Rows whose round does not fit the two-character race key (T7: ``lpad`` truncates 100 -> '10')."""
    return df.where(F.col(round_col) > max_round)


def report(tables: dict[str, DataFrame], not_null=NOT_NULL_TESTS, unique=UNIQUE_TESTS,
           relationships=(), known: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """(test_name, table_name, column_name, violations) for every test over the given tables.

    ``relationships`` items: (child_table, column, parent_table, field). ``known`` holds violations of not-null tests
    that the tables' writes observed, by (table, column); their tables are not scanned for them."""
    parts = []
    by_table: dict[str, list[str]] = {}
    told = [("not_null", t, c, known[t, c]) for t, c in not_null if known and (t, c) in known]
    if told:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(told, "test_name string, table_name string, column_name string, violations bigint"))
    for t, c in not_null:
        if not known or (t, c) not in known:
            by_table.setdefault(t, []).append(c)
    for t, cols in by_table.items():
        parts.append(not_null_counts(tables[t], t, cols))
    for t, cols in unique:
        v = unique_combination(tables[t], cols).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(v.select(F.lit("unique_combination").alias("test_name"), F.lit(t).alias("table_name"),
                              F.lit(",".join(cols)).alias("column_name"), "violations"))
    for ct, c, pt, f in relationships:
        v = relationship(tables[ct], c, tables[pt], f).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(v.select(F.lit("relationships").alias("test_name"), F.lit(ct).alias("table_name"),
                              F.lit(c).alias("column_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def assert_passed(report_df: DataFrame) -> DataFrame:
    """Raise ``ExpectationFailed`` listing the failing tests; return the report otherwise.
    Collects only the failing rows (at most one per test)."""
    failed = report_df.where(F.col("violations") > 0).collect()
    if failed:
        lines = ", ".join(f"{r.test_name}({r.table_name}.{r.column_name})={r.violations}" for r in failed)
        raise ExpectationFailed(f"{len(failed)} expectation(s) failed: {lines}")
    return report_df
