"""Stored tables: order within files (O1), bounded reads of many commits (K3, I6), upserts that read what they touch
(I4), counts observed by the writing job (E1, E4)."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions.columns import surrogate_key
from paddock.operators import expectations as ex
from paddock.plans import maintenance as mt
from paddock.sinks.tables import VersionedTable

from .conftest import rows


def _files(t, value):
    return [pq.ParquetFile(f) for f in sorted(glob.glob(f"{t.path}/vt_part=*/season_year={value}/*.parquet"))]


def test_files_are_ordered_and_row_groups_can_be_skipped(spark, scratch):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    df = spark.range(20_000).select((F.col("id") % 2).cast("int").alias("season_year"), F.hash("id").alias("place"), F.col("id").cast("string").alias("v"))
    tables = {order: VersionedTable(spark, scratch("ordered"), ["season_year"], order) for order in (("place",), ())}
    hadoop.setInt("parquet.block.size", 4096)
    try:
        for t in tables.values():
            t.overwrite(df.repartition(7))
    finally:
        hadoop.unset("parquet.block.size")
    ordered, loose = tables[("place",)], tables[()]
    assert rows(ordered.read()) == rows(loose.read())
    touched = {}
    for name, t in tables.items():
        groups = [f.metadata.row_group(i).column(0).statistics for f in _files(t, 1) for i in range(f.metadata.num_row_groups)]
        tenth = sorted(x for f in _files(t, 1) for x in f.read(["place"])["place"].to_pylist())[9]
        touched[name] = sum(g.min <= tenth for g in groups), len(groups)
    assert touched[("place",)][0] == 1 and touched[()][0] > 1 and touched[("place",)][1] > 3
    ranges = []
    for f in _files(ordered, 1):
        places = f.read(["place"])["place"].to_pylist()
        assert places == sorted(places)
        ranges.append((places[0], places[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_places_tell_an_unordered_file(spark, scratch):
    df = spark.createDataFrame([(1, p) for p in (3, 1, 2, 4)], "season_year int, place int").coalesce(1)
    loose = VersionedTable(spark, scratch("loose"), ["season_year"])
    loose.overwrite(df)
    assert mt.places(loose, "season_year", "place").where("place <> stored_place").count() > 0
    t = VersionedTable(spark, scratch("ordered"), ["season_year"], ["place"])
    t.overwrite(df)
    t.append(spark.createDataFrame([(2, 2), (2, 1), (None, 1)], "season_year int, place int"))
    t.replace_partitions(spark.createDataFrame([(1, 2), (1, 1)], "season_year int, place int"), [1])
    assert rows(mt.places(t, "season_year", "place")) == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2), (None, 1, 1)]


def test_the_read_filter_does_not_grow_with_commits(spark, scratch):
    t = VersionedTable(spark, scratch("many"), ["season_year"])
    want = {}
    for k in range(14):
        y = None if k % 5 == 4 else 2000 + k % 3
        t.replace_partitions(spark.createDataFrame([(y, k)], "season_year int, v int"), [y]) if t.exists() else t.overwrite(
            spark.createDataFrame([(y, k)], "season_year int, v int"))
        want[y] = k
        if k == 6:
            before = len(str(t.read()._jdf.queryExecution().analyzed()))
    assert {r.season_year: r.v for r in t.read().collect()} == want
    assert len(str(t.read()._jdf.queryExecution().analyzed())) <= before + 60
    plan = t.read().where("season_year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(vt_part" in plan and "Filter (" not in plan


def _keyed(spark, *rs):
    df = spark.createDataFrame(list(rs), "season_year int, driver string, v int")
    return df.select(surrogate_key("season_year", "driver").alias("k"), "*")


def test_upsert_does_not_read_other_partitions(spark, scratch):
    t = VersionedTable(spark, scratch("ups"), ["season_year"])
    key = surrogate_key("season_year", "driver")
    t.upsert(_keyed(spark, (1, "a", 1), (1, "b", 2), (2, "a", 3)), "k", key)  # creates the table
    for f in glob.glob(f"{t.path}/vt_part=*/season_year=2/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")
    t.upsert(_keyed(spark, (1, "a", 9), (1, "c", 8), (3, "a", 7)), "k", key)
    assert rows(t.read().where("season_year <> 2"), "season_year", "driver", "v") == [(1, "a", 9), (1, "b", 2), (1, "c", 8), (3, "a", 7)]
    with pytest.raises(Exception):  # without the key's expression the precondition scans them
        t.upsert(_keyed(spark, (1, "a", 5)), "k")
    wrong = _keyed(spark, (1, "a", 5)).withColumn("k", F.lit("x"))
    with pytest.raises(ValueError):
        t.upsert(wrong, "k", key)
    assert t.read().where("season_year = 1 AND v = 9").count() == 1


def test_upsert_writes_a_batch_once_and_shows_it_at_once(spark, scratch):
    t = VersionedTable(spark, scratch("once"), ["season_year"])
    key = surrogate_key("season_year", "driver")
    t.upsert(_keyed(spark, (1, "a", 1), (1, "b", 2), (2, "a", 3)), "k", key)
    t.upsert(_keyed(spark, (1, "a", 9), (1, "c", 8), (3, "a", 7)), "k", key)
    t.upsert(_keyed(spark, (1, "c", 6)), "k", key)
    files = glob.glob(f"{t.path}/vt_part=*/*/*.parquet")
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 3 + (1 + 3) + (2 + 1)  # kept rows and the batch
    assert len(t.commits()) == 3  # what an upsert changes appears with one row
    again = VersionedTable(spark, t.path, ["season_year"])
    for table in (t, again):
        assert rows(table.read(), "season_year", "driver", "v") == [(1, "a", 9), (1, "b", 2), (1, "c", 6), (2, "a", 3), (3, "a", 7)]


def test_writes_observe_what_they_write(spark, scratch):
    t = VersionedTable(spark, scratch("obs"), ["season_year"], ["place"])
    nulls = {"place": F.count_if(F.col("place").isNull())}
    df = lambda *rs: spark.createDataFrame(list(rs), "season_year int, place int").repartition(3)
    t.overwrite(df((1, 1), (1, None), (2, None), (2, 4)), observe=nulls)
    assert t.observed_total("place") == 2 and t.observed_total("other") is None
    t.replace_partitions(df((1, 1)), [1], observe=nulls)
    assert t.observed_total("place") is None  # one of the two went
    t.overwrite(df((1, 1)), observe=nulls)
    t.replace_partitions(df((1, 1)).where("false"), [1], observe=nulls)
    assert t.observed_total("place") == 0 and t.read().count() == 0
    t.append(df((3, 3)))
    assert t.observed_total("place") is None


def test_check_after_a_build_scans_for_no_nulls(spark, scratch, monkeypatch):
    from paddock.plans import build

    landing = {"raw_races": spark.createDataFrame([(2024, 1, "E", "C", "2024-03-01")], schemas.RAW_RACES),
               "raw_results": spark.createDataFrame([(2024, 1, "E", "7", "AAA", "N", "T", 1.0, 25.0, "Finished")], schemas.RAW_RESULTS),
               "raw_fastest_laps": spark.createDataFrame([(2024, 1, "E", "AAA", "T", 80.0)], schemas.RAW_FASTEST_LAPS)}
    wh = build.build_all(spark, landing, warehouse=scratch("seen"))
    asked = []
    monkeypatch.setattr(ex, "not_null_counts", lambda df, table, cols: asked.append((table, tuple(cols))))
    report = rows(build.check(wh))
    assert not asked and len([r for r in report if r[0] == "not_null"]) == len(ex.NOT_NULL_TESTS)
    monkeypatch.undo()
    # a mart with a violation: counted by its write
    bad = wh.mart("team_performance").read().withColumn("team_name", F.lit(None).cast("string"))
    wh.mart("team_performance").overwrite(bad, observe=ex.null_counters("team_performance"))
    with pytest.raises(ex.ExpectationFailed, match="team_performance.team_name\\)=1"):
        build.check(wh)
    # and one that was written without counting: by a scan
    wh.mart("team_performance").overwrite(bad)
    with pytest.raises(ex.ExpectationFailed, match="team_performance.team_name\\)=1"):
        build.check(wh)


@pytest.mark.parametrize("seed, partition", [(1, ["dbt_valid_to"]), (2, ["dbt_valid_to"]), (3, [])])
def test_snapshot_runs_in_any_order_equal_the_closed_form(spark, scratch, seed, partition):
    from paddock.operators import scd2

    rng = random.Random(seed)
    runs = {y: [(k, rng.choice("AB" if k == "a" else "ABC")) for k in ["a", "b", "c", "d", "e", None] if rng.random() < 0.7] for y in range(2000, 2009)}
    ts = lambda c: F.make_timestamp_ntz(c, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    t = VersionedTable(spark, scratch("any"), partition)
    order = rng.sample(sorted(runs), len(runs))
    seen = []
    for n, y in enumerate([*order, order[3]]):
        scd2.snapshot_step(t, spark.createDataFrame(runs[y], "k string, team string"), "k", ["team"], ts(F.lit(y)))
        seen.append(y)
        if n >= 4 and n % 2 == 0 or n == len(order):
            every = spark.createDataFrame([(y, *r) for y in sorted(set(seen)) for r in runs[y]], "year int, k string, team string")
            closed = scd2.history(every, "k", ["team"], "year", ts(F.col("year")))
            assert rows(scd2.versions(t)) == rows(closed.select(*scd2.versions(t).columns)), seen
    version = t.version()
    scd2.snapshot_step(t, spark.createDataFrame(runs[order[0]], "k string, team string"), "k", ["team"], ts(F.lit(order[0])))
    assert t.version() == version  # a repeated run changes nothing


def test_a_run_in_order_rewrites_no_closed_version(spark, scratch):
    from paddock.operators import scd2

    t = VersionedTable(spark, scratch("closed"), ["dbt_valid_to"])
    for y, team in ((2020, "X"), (2021, "Y"), (2022, "Y"), (2023, "Z")):
        scd2.snapshot_step(t, spark.createDataFrame([("a", team)], "k string, team string"), "k", ["team"], F.lit(f"{y}-01-01").cast("timestamp_ntz"))
    assert [list(c.hidden) for c in t.commits()[1:]] == [["\u0000null"]] * 3
    scd2.snapshot_step(t, spark.createDataFrame([("a", "X")], "k string, team string"), "k", ["team"], F.lit("2021-06-01").cast("timestamp_ntz"))
    got = [(r.team, r.dbt_valid_from.year, r.dbt_valid_from.month, r.dbt_valid_to and r.dbt_valid_to.year) for r in t.read().orderBy("dbt_valid_from").collect()]
    assert got == [("X", 2020, 1, 2021), ("Y", 2021, 1, 2021), ("X", 2021, 6, 2022), ("Y", 2022, 1, 2023), ("Z", 2023, 1, None)]
