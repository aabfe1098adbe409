"""Relational operators: NOT IN rules, skew-safe running sum, top-k, lookup, expectations."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paddock.operators import expectations as ex
from paddock.operators.incremental import first_batch_wins, not_in, upsert_by_key
from paddock.operators.lookup import lookup_with_default
from paddock.operators.ranking import first_n_distinct, first_value_by, top_k, top_k_per_group
from paddock.operators.running import running_sum

from .conftest import rows


def _probe(spark):
    return spark.createDataFrame([("a",), ("b",), (None,)], "k string")


@pytest.mark.parametrize("keys,want", [
    ([], ["a", "b", None]),          # empty set: every row, null included
    (["a"], ["b"]),                  # null probe dropped
    (["a", None], []),               # a null in the set blocks everything
    ([None], []),
])
def test_not_in_three_valued_logic(spark, keys, want):  # T4
    k = spark.createDataFrame([(x,) for x in keys], "key string")
    got = [r.k for r in not_in(_probe(spark), "k", k, "key").collect()]
    assert sorted(got, key=lambda v: (v is None, v)) == sorted(want, key=lambda v: (v is None, v))
    p, kk = _probe(spark), k
    p.createOrReplaceTempView("p")
    kk.createOrReplaceTempView("kk")
    sql = [r.k for r in spark.sql("SELECT k FROM p WHERE k NOT IN (SELECT key FROM kk)").collect()]
    assert sorted(sql, key=lambda v: (v is None, v)) == sorted(got, key=lambda v: (v is None, v))


def test_running_sum_equals_single_window_with_hot_key(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else rnd.randint(1, 40)   # user 0 holds a third of all rows
        user = None if i % 97 == 0 else user             # and a null group
        data.append((user, rnd.randint(1, 30), i, rnd.randint(1, 100) / 4))
    df = spark.createDataFrame(data, "u int, day int, seq int, v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
    two = running_sum(df, ["u"], ["day", "seq"], "v", "run", chunk="day")
    w = Window.partitionBy("u").orderBy("day", "seq").rowsBetween(Window.unboundedPreceding, 0)
    one = df.withColumn("run", F.sum("v").over(w))
    assert rows(two, "u", "day", "seq", "run") == rows(one, "u", "day", "seq", "run")
    # last running value of a key = its group sum
    last = two.groupBy("u").agg(F.max("run").alias("m"))
    tot = df.groupBy("u").agg(F.sum("v").alias("m"))
    assert rows(last) == rows(tot)


def test_top_k_per_group_and_global(spark):
    df = spark.createDataFrame([(s, d, p) for s in (1, 2) for d, p in enumerate([5, 9, 9, 1, 7])],
                               "s int, d int, p int")
    top = top_k_per_group(df, ["s"], [F.col("p").desc(), F.col("d").asc()], 2)
    assert rows(top) == [(1, 1, 9), (1, 2, 9), (2, 1, 9), (2, 2, 9)]
    assert [tuple(r) for r in top_k(df, [F.col("p").asc(), "s", "d"], 1).collect()] == [(1, 3, 1)]
    first = first_value_by(df, ["s"], "p", ["d"])
    assert rows(first) == [(1, 5), (2, 5)]
    assert rows(first_n_distinct(df, [], "p", 2)) == [(1,), (5,)]


def test_lookup_with_default(spark):
    facts = spark.createDataFrame([("Ferrari",), ("Nobody",), (None,)], "team string")
    dim = spark.createDataFrame([("Ferrari", "#E8002D")], "team string, colour string")
    got = {r.team: r.colour for r in lookup_with_default(facts, "team", dim.withColumnRenamed("team", "t"), "t",
                                                          "colour", "#e10600").collect()}
    assert got == {"Ferrari": "#E8002D", "Nobody": "#e10600", None: "#e10600"}


def test_expectations(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, 3)], "a int, b int")
    nn = {r.column_name: r.violations for r in ex.not_null_counts(df, "t", ["a", "b"]).collect()}
    assert nn == {"a": 0, "b": 1}
    uc = ex.unique_combination(df, ["a"]).collect()
    assert [(r.a, r.row_count) for r in uc] == [(1, 2)]
    parent = spark.createDataFrame([(2,), (3,)], "b int")
    assert [r.from_field for r in ex.relationship(df, "b", parent, "b").collect()] == []
    assert sorted(r.from_field for r in ex.relationship(df, "a", parent, "b").collect()) == [1, 1]
    rep = ex.report({"t": df}, not_null=(("t", "a"), ("t", "b")), unique=(("t", ("a",)),))
    with pytest.raises(ex.ExpectationFailed, match="not_null\\(t.b\\)=1"):
        ex.assert_passed(rep)
    ok = ex.report({"t": df}, not_null=(("t", "a"),), unique=())
    assert ex.assert_passed(ok) is ok
    rounds = spark.createDataFrame([(99,), (100,)], "round int")
    assert [r["round"] for r in ex.round_fits_key(rounds).collect()] == [100]


def test_upsert_by_key(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string")
    assert rows(upsert_by_key(target, batch, "k")) == [(1, "x"), (2, "c"), (3, "y")]


def test_first_batch_wins_equals_its_window_form(spark):
    df = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 2), ("r2", 3), ("r2", 2), (None, 3), (None, 2)],
                               "race string, b int")
    window = (df.withColumn("_first", F.min("b").over(Window.partitionBy("race")))
              .where(F.col("b") == F.col("_first")).drop("_first"))
    assert rows(first_batch_wins(df, "race", "b")) == rows(window)


def test_distributed_row_number_equals_window(spark):
    from paddock.operators.ranking import distributed_row_number

    rnd = random.Random(5)
    data = [(0 if i % 2 else rnd.randint(1, 4), float(rnd.randint(0, 5)), f"d{i:04d}") for i in range(1500)]
    data += [(None, 1.0, "n1"), (None, 1.0, "n0")]
    df = spark.createDataFrame(data, "season int, pts double, code string").withColumn("head", F.substring("code", 1, 3))
    order = [F.col("pts").desc_nulls_last(), F.col("code").asc_nulls_last()]
    got = distributed_row_number(df, ["season"], [("pts", True), ("head", False)], order, "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("season").orderBy(*order)).cast("bigint"))
    assert rows(got) == rows(want)


def test_running_sum_keeps_rows_without_an_order(spark):
    data = [("a", 1, 1, 0.1), ("a", None, 2, 0.2), ("a", 2, 3, 0.7), (None, None, 4, 0.4), ("a", None, 5, None), ("b", 1, 6, None)]
    df = spark.createDataFrame(data, "u string, day int, seq int, v double").withColumn("v", F.col("v").cast("decimal(18,6)"))
    got = {r.seq: None if r.run is None else float(r.run) for r in running_sum(df, ["u"], ["day", "seq"], "v", "run", chunk="day").collect()}
    assert got == {1: 0.1, 3: 0.8, 2: 1.0, 5: 1.0, 4: 0.4, 6: None}


def test_sorted_values_have_places(spark):
    from paddock.operators.ranking import sorted_values

    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (2, "z")], "s int, v string")
    assert {tuple(r) for r in sorted_values(df, ["s"], "v", "p").collect()} == {(1, "a", 1), (1, "b", 2), (2, "z", 1), (2, None, 2)}
    assert {tuple(r) for r in sorted_values(df, [], "s", "p", descending=True).collect()} == {(2, 1), (1, 2)}


def test_cumulative_points_with_fine_blocks_equals_plain_window(spark, monkeypatch):
    from paddock.plans import analytics

    monkeypatch.setattr(analytics, "CHUNK_BLOCK_BITS", 2)   # blocks of 4 order keys: many chunks per round
    rnd = random.Random(3)
    data = [(2022, "HOT" if i % 3 else f"D{i % 5}", "n", "t", rnd.randint(1, 3), i, float(rnd.randint(0, 25)))
            for i in range(600)]
    stg = spark.createDataFrame(data, "season_year int, driver_code string, driver_name string, team_name string, "
                                      "round_number int, k long, points_scored double")
    got = analytics.cumulative_points(stg, tiebreak=("k",), block_first_tiebreak=True)
    w = Window.partitionBy("season_year", "driver_code").orderBy("round_number", "k") \
        .rowsBetween(Window.unboundedPreceding, 0)
    want = stg.withColumn("cumulative_points", F.sum("points_scored").over(w))
    assert rows(got, "driver_code", "k", "cumulative_points") == rows(want, "driver_code", "k", "cumulative_points")
