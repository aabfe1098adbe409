"""Table maintenance: versioned tables, incremental runs (stepwise = closed form, idempotent),
season replace, SCD2 (stepwise = gaps and islands, interval properties)."""

import pytest
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions.columns import race_id
from paddock.operators import incremental as inc
from paddock.plans import maintenance as mt
from paddock.plans import staging
from paddock.sinks.tables import VersionedTable
from paddock.sources import bindings as b
from paddock.sources.readers import conform

from .conftest import SF_SMALL, rows


def test_versioned_table_lifecycle(spark, scratch):
    t = VersionedTable(spark, scratch("vt"), partition_by=["year"])
    assert not t.exists()
    like = spark.createDataFrame([(2022, "a")], "year int, v string")
    t.create_empty(like).create_empty(like)
    assert t.version() == 1 and t.read().count() == 0
    t.append(spark.createDataFrame([(2022, "a"), (2023, "b")], "year int, v string"))
    # bound by name, not position
    t.append(spark.createDataFrame([("c", 2024)], "v string, year int"))
    assert rows(t.read()) == [(2022, "a"), (2023, "b"), (2024, "c")]
    # replace one season, and empty another with an empty frame
    t.replace_partitions(spark.createDataFrame([(2023, "B1"), (2023, "B2")], "year int, v string"), [2023])
    t.replace_partitions(like.where(F.lit(False)), [2022])
    assert rows(t.read()) == [(2023, "B1"), (2023, "B2"), (2024, "c")]
    t.compact()
    assert rows(t.read()) == [(2023, "B1"), (2023, "B2"), (2024, "c")]
    # a second reader sees the same version through the log
    assert rows(VersionedTable(spark, t.path).read()) == rows(t.read())


def test_failed_write_keeps_previous_version(spark, scratch):
    t = VersionedTable(spark, scratch("fail"))
    t.overwrite(spark.createDataFrame([(1, "a")], "k int, v string"))
    v = t.version()
    bad = spark.createDataFrame([(2, "x")], "k int, v string").withColumn("k", F.col("v").cast("int"))
    with pytest.raises(Exception):
        t.append(bad)
    fresh = VersionedTable(spark, t.path)
    assert fresh.version() == v and rows(fresh.read()) == [(1, "a")]


def test_incremental_stepwise_equals_closed_form_and_is_idempotent(spark, scratch):
    target = VersionedTable(spark, scratch("inc"), partition_by=["season_year"])
    for k in (1, 2, 3):
        raw = conform(b.results_like(spark, SF_SMALL).where(b.upto_batch(k)), schemas.RAW_RESULTS)
        inc.incremental_stage(target, raw, staging.stage_results, race_id("year", "round"))
    n = target.read().count()
    # a second run over the same landing adds nothing
    again = inc.incremental_stage(target, conform(b.results_like(spark, SF_SMALL), schemas.RAW_RESULTS),
                                  staging.stage_results, race_id("year", "round"))
    assert again.count() == 0 and target.read().count() == n
    closed = inc.first_batch_wins(
        b.results_like(spark, SF_SMALL).withColumn("_b", F.when(b.in_batch(1), 1).when(b.in_batch(2), 2).otherwise(3)).withColumn("race_id", race_id("year", "round")),
        "race_id", "_b")
    assert rows(target.read()) == rows(staging.stage_results(closed))
    # late rows exist: the closed form drops some rows of the landing
    assert closed.count() < b.results_like(spark, SF_SMALL).count()


def test_replace_season_query(spark, scratch):
    t = VersionedTable(spark, scratch("rs"), partition_by=["year"])
    got = mt.replace_season(spark, SF_SMALL, t.path)
    assert rows(got) == rows(b.races_like(spark, SF_SMALL))
    # one commit per later batch; after batch 2 the season it does not reach was empty
    assert [c.op for c in t.commits()] == ["overwrite", "replace", "replace"]
    t._log_rows = t.commits()[:2]
    assert t.read().where("year = 2001").count() == 0 and t.read().where("year = 1999").count() > 0


def test_scd2_stepwise_equals_closed_form(spark, scratch):
    step = mt.scd2_history(spark, SF_SMALL, scratch("scd"))
    closed = mt.scd2_closed_form(spark, SF_SMALL)
    assert rows(step) == rows(closed.select(*step.columns))
    # exactly one open version per key, and versions of a key do not overlap
    assert step.groupBy("snapshot_sk").agg(F.count_if(F.col("dbt_valid_to").isNull()).alias("o")) \
        .where("o != 1").count() == 0
    assert step.where("dbt_valid_to IS NOT NULL AND dbt_valid_to <= dbt_valid_from").count() == 0
    a, c = step.alias("a"), step.alias("c")
    overlap = a.join(c, (F.col("a.snapshot_sk") == F.col("c.snapshot_sk"))
                     & (F.col("a.dbt_valid_from") < F.col("c.dbt_valid_from"))
                     & (F.coalesce(F.col("a.dbt_valid_to"), F.lit("9999-01-01").cast("timestamp_ntz"))
                        > F.col("c.dbt_valid_from")))
    assert overlap.count() == 0


def test_scd2_step_semantics(spark, scratch):
    from paddock.operators import scd2
    t = VersionedTable(spark, scratch("scd_small"))
    ts = lambda y: F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz")
    s = "k string, team string, name string"
    scd2.snapshot_step(t, spark.createDataFrame([("a", "X", "n1"), ("b", "Y", "n2")], s), "k", ["team"], ts(2020))
    # a changes team, b vanishes, c appears, a's name change alone is not a change
    scd2.snapshot_step(t, spark.createDataFrame([("a", "Z", "n1b"), ("c", None, "n3")], s), "k", ["team"], ts(2021))
    scd2.snapshot_step(t, spark.createDataFrame([("a", "Z", "n1c"), ("c", None, "n3")], s), "k", ["team"], ts(2022))
    got = {(r.k, r.team): (r.dbt_valid_from.year, r.dbt_valid_to.year if r.dbt_valid_to else None)
           for r in t.read().collect()}
    assert got == {("a", "X"): (2020, 2021), ("a", "Z"): (2021, None), ("b", "Y"): (2020, None),
                   ("c", None): (2021, None)}


def test_csv_round_trip(spark, scratch):
    got = mt.csv_round_trip(spark, SF_SMALL, scratch("csv"))
    want = conform(b.results_like(spark, SF_SMALL), schemas.RAW_RESULTS)
    assert rows(got) == rows(want)


def test_build_all_is_idempotent_and_streaming_equals_batch(spark, scratch):
    from paddock.plans.build import MARTS, Warehouse, build_all, landing_from_testdata

    wh = Warehouse(spark, scratch("wh"))
    landing = landing_from_testdata(spark, SF_SMALL, 3)
    build_all(spark, landing, warehouse=wh)
    first = {n: rows(wh.mart(n).read()) for n in MARTS}
    n_stg = wh.stg_results.read().count()
    build_all(spark, landing, warehouse=wh)   # same landing again: nothing changes
    assert {n: rows(wh.mart(n).read()) for n in MARTS} == first
    assert wh.stg_results.read().count() == n_stg

    streamed = mt.stream_incremental_results(spark, SF_SMALL, scratch("stream"))
    batch = mt.incremental_results(spark, SF_SMALL, scratch("batch"))
    assert rows(streamed) == rows(batch)


def test_a_race_split_over_files_of_a_landing_is_staged_whole(spark, scratch):
    from paddock.streaming.incremental import stream_incremental_stage

    root = scratch("split")
    raw = spark.createDataFrame([(2024, 1, "E", str(i), f"D{i}", f"n{i}", "T", 1.0, 1.0, "Finished") for i in range(6)], schemas.RAW_RESULTS)
    raw.repartition(3).write.parquet(f"{root}/landing")
    target = VersionedTable(spark, f"{root}/stg", partition_by=["season_year"])
    stream_incremental_stage(spark, f"{root}/landing", schemas.RAW_RESULTS, target, staging.stage_results, race_id("year", "round"), f"{root}/_ckpt")
    assert rows(target.read()) == rows(staging.stage_results(raw))


def test_stream_restart_processes_only_new_files(spark, scratch):
    from paddock.streaming.incremental import stream_incremental_stage

    root = scratch("restart")
    target = VersionedTable(spark, f"{root}/stg", partition_by=["season_year"])
    raw = conform(b.results_like(spark, SF_SMALL), schemas.RAW_RESULTS)
    raw.where(b.in_batch(1)).write.parquet(f"{root}/landing/b1")
    args = (spark, f"{root}/landing/*", schemas.RAW_RESULTS, target, staging.stage_results,
            race_id("year", "round"), f"{root}/_ckpt")
    stream_incremental_stage(*args)
    v, n = target.version(), target.read().count()
    stream_incremental_stage(*args)        # nothing new landed: no commit
    assert target.version() == v and target.read().count() == n
    raw.where(b.in_batch(2)).write.parquet(f"{root}/landing/b2")
    stream_incremental_stage(*args)
    assert target.read().count() > n


def test_log_grows_by_one_row_a_commit(spark, scratch):
    t = VersionedTable(spark, scratch("log"), partition_by=["year"])
    t.append(spark.createDataFrame([(2022, "a")], "year int, v string"))
    t.append(spark.createDataFrame([(2023, "b"), (2024, "c")], "year int, v string"))
    t.replace_partitions(spark.createDataFrame([(2022, "A")], "year int, v string"), [2022])
    assert spark.read.parquet(t._log).count() == 3 == t.version()
    assert rows(VersionedTable(spark, t.path).read()) == [(2022, "A"), (2023, "b"), (2024, "c")]
    t.compact()
    assert len(VersionedTable(spark, t.path).commits()) == 1


def test_only_a_missing_log_is_a_new_table(spark, scratch):
    from pyspark.errors import AnalysisException

    assert not VersionedTable(spark, scratch("none")).exists()
    path = scratch("broken")
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{path}/other")
    spark.createDataFrame([("x",)], "v string").write.text(f"{path}/_commits")
    with pytest.raises(Exception) as e:
        VersionedTable(spark, path).exists()
    assert not isinstance(e.value, (AssertionError, FileNotFoundError)) and AnalysisException is not None


def test_table_upsert_touches_only_batch_partitions(spark, scratch):
    t = VersionedTable(spark, scratch("ups"), partition_by=["season"])
    t.overwrite(spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "c", 4)], "season int, k string, v int"))
    t.upsert(spark.createDataFrame([(1, "a", 9), (1, "z", 8)], "season int, k string, v int"), "k")
    assert rows(t.read()) == [(1, "a", 9), (1, "b", 3), (1, "z", 8), (2, "c", 4)]
    assert [list(c.hidden) for c in t.commits()] == [[], ["1"]]     # only season 1 of the old part
    with pytest.raises(ValueError):                                 # the key is there, in another season
        t.upsert(spark.createDataFrame([(2, "a", 1)], "season int, k string, v int"), "k")


def _landing(spark, races, results, laps=()):
    return {"raw_races": spark.createDataFrame(races, schemas.RAW_RACES), "raw_results": spark.createDataFrame(results, schemas.RAW_RESULTS),
            "raw_fastest_laps": spark.createDataFrame(list(laps), schemas.RAW_FASTEST_LAPS)}


def _result(year, rnd, code="AAA", points=25.0):
    return (year, rnd, "E", "7", code, "Name", "Team", 1.0, points, "Finished")


def test_build_by_seasons_neither_doubles_nor_loses(spark, scratch):
    from paddock.operators.expectations import ExpectationFailed
    from paddock.plans.build import Warehouse, build_all

    landing = _landing(spark, [(y, 1, "E", "C", f"{y}-03-01") for y in (2024, 2025)], [_result(2024, 1), _result(2025, 1)],
                       [(y, 1, "E", "AAA", "Team", 80.0) for y in (2024, 2025)])
    wh = Warehouse(spark, scratch("seasons"))
    for seasons in ([2025], [2024], [2025, 2024]):
        build_all(spark, landing, seasons, wh)
    got = {r.season_year: (r.races_entered, r.total_points) for r in wh.mart("driver_standings").read().collect()}
    assert got == {2024: (1, 25.0), 2025: (1, 25.0)} and wh.raw_results.read().count() == 2
    # results of a season whose calendar is stored already need no landed calendar
    build_all(spark, _landing(spark, [], [_result(2025, 1, "BBB"), ]), warehouse=wh)
    assert wh.raw_races.read().count() == 2
    for bad in ([_result(2023, 1)], [_result(2025, 100)], [_result(None, 1)]):  # no calendar row, no room in the key, no season
        with pytest.raises(ExpectationFailed):
            build_all(spark, _landing(spark, [(2025, 100, "E", "C", "2025-01-01")], bad), warehouse=wh)
    assert wh.raw_results.read().count() == 2


def test_build_coerces_and_drops_testing_events(spark, scratch):
    from paddock.plans.build import build_all

    landing = _landing(spark, [(2024, 0, "Testing", "C", "2024-02-01"), (None, 1, "Opening", "C", "2024-03-01")],
                       [(None, 1, "x", None, None, "Name", None, float("nan"), 3.0, None), _result(2024, 0)],
                       [(None, 1, "Opening", "AAA", "Team", 80.0)])
    wh = build_all(spark, landing, None, scratch("coerce"), season=2024)
    (r,) = wh.raw_results.read().collect()
    assert tuple(r) == (2024, 1, "Opening", "", "", "Name", "", None, 3.0, "")
    assert [x.round_number for x in wh.stg_races.read().collect()] == [1]
    assert wh.report.where("test_name = 'relationships'").count() == 2


def test_scd2_driver_team_has_movers(spark, scratch):
    t = mt.scd2_driver_team(spark, SF_SMALL, scratch("dt"))
    versions = t.groupBy("driver_code", "season_year").count()
    assert versions.where("count > 1").count() > 0 and t.where("dbt_valid_to IS NULL").count() == versions.count()


def test_snapshot_keeps_a_null_key(spark, scratch):
    from paddock.operators import scd2
    t = VersionedTable(spark, scratch("null_key"), partition_by=["dbt_valid_to"])
    ts = lambda y: F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz")
    for y, team in ((2020, "X"), (2021, "X"), (2022, "Y")):
        scd2.snapshot_step(t, spark.createDataFrame([(None, team)], "k string, team string"), "k", ["team"], ts(y))
    assert sorted((r.team, r.dbt_valid_to is None) for r in t.read().collect()) == [("X", False), ("Y", True)]
