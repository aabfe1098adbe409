"""Every registered query against its SQL oracle on DuckDB at sf0.001 (the driver's check runs the
same comparison at sf0.01): same columns, same types, same multiset of rows."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from paddock import registry
from tools.check_oracle import TABLES, canon_duck, canon_spark, rows_of

from .conftest import SF_SMALL

# the training-data queries are tested in tests/llm
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["season_year", "driver_code", "driver_name", "team_name"]


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], f"{name}: forbidden operator in plan"
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {r[0]: canon_duck(r[1]) for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {f.name: canon_spark(f.dataType) for f in df.schema.fields} == dtypes
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)
