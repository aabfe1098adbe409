"""Guarded ad-hoc SQL (H1), DESCRIBE (S9), bounded preview (K9), parameterised season filter (F2)."""

import pytest

from paddock.plans import adhoc, analytics, marts, staging
from paddock.plans import models

from .conftest import SF_SMALL


def _views(spark):
    return {"driver_standings": models.driver_standings(spark, SF_SMALL)}


def test_query_runs_and_trailing_semicolon_is_accepted(spark):
    df, err = adhoc.run_adhoc(spark, "  SELECT season_year, count(*) AS n FROM driver_standings GROUP BY 1 ;",
                              _views(spark))
    assert err is None and df.count() > 0


def test_ddl_commands_and_multi_statements_are_refused_as_text(spark):
    for sql in ("DROP TABLE driver_standings", "CREATE TABLE x AS SELECT 1",
                "SELECT 1; SELECT 2", "INSERT INTO driver_standings SELECT * FROM driver_standings",
                "SELECT * FROM no_such_table", "SET spark.sql.shuffle.partitions=1"):
        df, err = adhoc.run_adhoc(spark, sql, _views(spark))
        assert df is None and err.startswith(adhoc.ERROR_PREFIX), sql


def test_describe_and_preview(spark):
    adhoc.register_views(_views(spark))
    cols = adhoc.describe(spark, "driver_standings")
    assert cols[0] == "season_year (int)" and "championship_position (bigint)" in cols
    text = adhoc.preview(spark.table("driver_standings"), 3)
    assert len(text.splitlines()) == 5 and "there are more" in text


def test_season_parameter_prunes_stored_partitions(spark, scratch):
    from paddock.sinks.tables import VersionedTable

    t = VersionedTable(spark, scratch("stg"), partition_by=["season_year"])
    t.overwrite(models.stg_results(spark, SF_SMALL))
    one = analytics.season_slice(marts.driver_standings(t.read()), season=1996)
    assert {r.season_year for r in one.collect()} == {1996}
    plan = analytics.cumulative_points(t.read(), season=1996)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season_year" in plan and "(season_year#" in plan


def test_exclude_testing_events(spark):
    cal = spark.createDataFrame([(2024, 0, "Pre-Season Testing"), (2024, 1, "Bahrain Grand Prix")],
                                "year int, round int, event_name string")
    assert [r["round"] for r in staging.exclude_testing_events(cal).collect()] == [1]


def _numbers(spark, n):
    return {"numbers": spark.range(n)}


def test_errors_while_running_and_comments_and_cuts(spark, scratch):
    text, failed = adhoc.answer(spark, "SELECT 1 / (id - 1) AS x FROM numbers", _numbers(spark, 3))
    assert failed and text.startswith(adhoc.ERROR_PREFIX) and len(text) > len(adhoc.ERROR_PREFIX)
    text, failed = adhoc.answer(spark, "SELECT count(*) AS n FROM numbers -- all of them", _numbers(spark, 7))
    assert not failed and text.split() == ["n", "7"]
    text, failed = adhoc.answer(spark, "SELECT id FROM numbers", _numbers(spark, 250))
    assert not failed and "there are more" in text
    assert "there are more" not in adhoc.answer(spark, "SELECT id FROM numbers", _numbers(spark, 100))[0]
    out = scratch("answer")
    assert adhoc.answer(spark, "SELECT id FROM numbers", _numbers(spark, 250), output=out) == (f"written to {out}", False)
    assert spark.read.option("header", True).csv(out).count() == 250


CALL = "('java.lang.System', 'getProperty', 'user.dir')"
REFUSED = [
    f"SELECT java_method{CALL}", f"SELECT `reflect`{CALL}", f"SELECT reflect/**/{CALL}", f"SELECT try_reflect{CALL}",
    f"SELECT * FROM VALUES (reflect{CALL}) t(a)", f"SELECT * FROM numbers WHERE id IN (SELECT length(reflect{CALL}) FROM numbers)",
    f"SELECT (SELECT max(reflect{CALL}) FROM numbers)", f"WITH a AS (SELECT reflect{CALL} x) SELECT * FROM a",
    f"SELECT system.builtin.reflect{CALL}", f"SELECT transform(array(1), x -> reflect{CALL})", f"SELECT id FROM numbers ORDER BY reflect{CALL}",
    f"SELECT sum(length(reflect{CALL})) OVER () FROM numbers", f"SELECT e FROM numbers LATERAL VIEW explode(array(reflect{CALL})) t AS e",
    f"SELECT * FROM parquet.`{SF_SMALL}/nation.parquet`", f"SELECT * FROM csv.`{SF_SMALL}`", "SELECT * FROM range(3)", "SELECT * FROM explode(array(1))",
    "SELECT * FROM secret", "SELECT (SELECT max(id) FROM secret)", "SELECT * FROM numbers, LATERAL (SELECT * FROM secret)",
    "SELECT plus_one(id) FROM numbers", "SELECT py_one(id) FROM numbers", "SELECT current_user()", "SELECT input_file_name() FROM numbers",
    "SELECT raise_error('x')", "SELECT uuid()", "SELECT * FROM spark_catalog.default.numbers", "SELECT version()",
    "WITH RECURSIVE r AS (SELECT 1 AS i UNION ALL SELECT i + 1 FROM r) SELECT * FROM r", "SELECT * FROM numbers) q; DROP VIEW numbers --",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_only_queries_over_the_views_are_admitted(spark, sql):
    spark.range(5).createOrReplaceTempView("secret")
    spark.udf.register("py_one", lambda x: x)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION plus_one(x BIGINT) RETURNS BIGINT RETURN x + 1")
    df, err = adhoc.run_adhoc(spark, sql, _numbers(spark, 3))
    assert df is None and err.startswith(adhoc.ERROR_PREFIX)
    assert spark.table("numbers").count() == 3


def test_a_views_name_does_not_admit_another_relation(spark, scratch):
    path = scratch("file")
    spark.range(2).write.parquet(path)
    for sql in (f"WITH numbers AS (SELECT * FROM parquet.`{path}`) SELECT * FROM numbers", "WITH secret AS (SELECT 1) SELECT * FROM (SELECT * FROM secret), range(2)"):
        assert adhoc.run_adhoc(spark, sql, _numbers(spark, 3))[0] is None, sql
    # a function of the user's that hides a built-in one
    other = spark.newSession()
    other.udf.register("soundex", lambda x: "hidden")
    df, err = adhoc.run_adhoc(other, "SELECT soundex('a') AS x", {})
    assert df is None and err.startswith(adhoc.ERROR_PREFIX)


ADMITTED = [
    "SELECT driver_name, wins FROM driver_standings WHERE season_year = 1996 ORDER BY wins DESC, driver_name LIMIT 1",
    "WITH t AS (SELECT season_year, max(total_points) AS p FROM driver_standings GROUP BY season_year HAVING count(*) > 1) "
    "SELECT d.driver_name, t.p FROM driver_standings d JOIN t ON d.season_year = t.season_year AND d.total_points = t.p",
    "SELECT driver_name, rank() OVER (PARTITION BY season_year ORDER BY total_points DESC NULLS LAST) AS r, sum(wins) OVER (ORDER BY driver_name "
    "ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS w, lag(wins, 1, 0) OVER (PARTITION BY team_name ORDER BY season_year) AS l FROM driver_standings",
    "SELECT CASE WHEN wins > 0 THEN 'won' ELSE 'not' END AS k, count(DISTINCT team_name) AS n, round(avg(total_points), 2) AS a, "
    "count(*) FILTER (WHERE podiums > 1) AS f FROM driver_standings GROUP BY 1",
    "SELECT * FROM driver_standings WHERE driver_name LIKE 'Driver%' AND season_year BETWEEN 1995 AND 1997 AND wins IN (0, 1, 2) AND team_name IS NOT NULL",
    "SELECT upper(left(driver_name, 3)) || '-' || lpad(cast(wins AS STRING), 3, '0') AS k, nullif(wins, 0) AS w, coalesce(best_finish, -1) AS b, "
    "concat_ws(',', driver_code, team_name) AS c, total_points / nullif(races_entered, 0) AS p FROM driver_standings",
    "SELECT season_year FROM driver_standings WHERE wins > (SELECT avg(wins) FROM driver_standings) UNION SELECT season_year FROM driver_standings "
    "WHERE EXISTS (SELECT 1 FROM driver_standings d WHERE d.team_name = driver_standings.team_name) EXCEPT SELECT 1995",
    "SELECT season_year, team_name, sum(wins) AS w FROM driver_standings GROUP BY ROLLUP (season_year, team_name)",
    "SELECT * FROM (SELECT season_year, team_name, wins FROM driver_standings) PIVOT (sum(wins) FOR season_year IN (1995, 1996))",
    "SELECT t.a, date_add(DATE '2024-01-01', t.a) AS d, extract(YEAR FROM current_date()) > 2000 AS y FROM VALUES (1), (2) t(a)",
    "SELECT team_name, c FROM (SELECT team_name, collect_list(driver_code) AS cs FROM driver_standings GROUP BY 1) LATERAL VIEW explode(cs) x AS c",
    "SELECT transform(array_sort(collect_set(season_year)), y -> y + 1)[0] AS y, max_by(driver_name, wins) AS m, percentile_approx(wins, 0.5) AS p FROM driver_standings",
    "SELECT ceil(total_points / 3) AS c, floor(avg_finish_position) AS f, timestampdiff(DAY, DATE '2024-01-01', current_date()) > 0 AS d, "
    "startswith(driver_name, 'D') AS s, mode(wins) OVER () AS m FROM driver_standings",
    "SELECT DISTINCT season_year AS y, struct(wins, podiums).wins AS w FROM driver_standings ORDER BY y DESC LIMIT 5 OFFSET 1",
]


@pytest.mark.parametrize("sql", ADMITTED)
def test_queries_over_the_marts_are_answered(spark, sql):
    df, err = adhoc.run_adhoc(spark, sql, _views(spark))
    assert err is None, err
    df.collect()
