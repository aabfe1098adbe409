"""The training-data queries that SQL can express, against their SQL on DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from paddock.llm import queries
from tools.check_oracle import canon_duck, canon_spark, rows_of

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, sql = queries.QUERIES[name](spark, SF), queries.ORACLES[name]
    got, cur = [tuple(r) for r in df.collect()], con.execute(sql)
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert {f.name: canon_spark(f.dataType) for f in df.schema.fields} == {r[0]: canon_duck(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert rows_of(df.columns, got) == rows_of(columns, want)


@pytest.mark.parametrize("name", ["op6_mixing", "op10_quality_rules"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
