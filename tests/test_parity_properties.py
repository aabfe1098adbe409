"""Numeric parity with the SQL oracle on random inputs (T1 rounding, T2 cast, T3 lap format).

Each example is a batch of values checked in one Spark query against one DuckDB query."""

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paddock.functions import columns as C

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
laps = st.integers(min_value=0, max_value=7_200_000).map(lambda ms: ms / 1000.0)
ratios = st.tuples(st.integers(1, 5000), st.integers(1, 200)).map(lambda t: t[0] / t[1])


def _duck(values, expr):
    con = duckdb.connect()
    con.register("v", pd.DataFrame({"i": range(len(values)), "x": values}))
    return [r[0] for r in con.execute(f"SELECT {expr} FROM v ORDER BY i").fetchall()]


def _spark(spark, values, col_fn):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double")
    return [r.y for r in df.select("i", col_fn(F.col("x")).alias("y")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(finite, ratios), min_size=50, max_size=200), st.integers(0, 3))
def test_round_matches(spark, values, digits):
    assert _spark(spark, values, lambda c: C.round_half_away(c, digits)) == _duck(values, f"round(x, {digits})")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(finite, st.integers(-1000, 1000).map(lambda i: i / 2)), min_size=50, max_size=200))
def test_int_cast_matches(spark, values):
    assert _spark(spark, values, C.to_int) == _duck(values, "CAST(x AS INTEGER)")


@settings(max_examples=5, deadline=None)
@given(st.lists(laps, min_size=50, max_size=200))
def test_lap_format_matches_after_rounding(spark, values):
    got = _spark(spark, values, lambda c: C.format_lap_time(C.round_half_away(c, 3)))
    want = _duck(values, "CAST(CAST(floor(round(x, 3) / 60) AS INTEGER) AS VARCHAR) || ':' || "
                         "printf('%06.3f', round(x, 3) % 60)")
    assert got == want
