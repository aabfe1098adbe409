"""Rows that wait in a stream for their race's marker (section 2.14)."""

from datetime import datetime, timedelta

import pytest

from paddock import schemas
from paddock.plans import staging
from paddock.streaming.marked import MARKERS, MarkedRaces, landed_schema

from .conftest import rows

T0 = datetime(2024, 1, 1)
LANDED = landed_schema(schemas.RAW_RESULTS)


def result(rnd, code, hours, year=2024):
    return (year, rnd, "E", "7", code, "Name", "Team", 1.0, 25.0, "Finished", T0 + timedelta(hours=hours))


def marker(rnd, expected, hours, year=2024):
    return (year, rnd, expected, T0 + timedelta(hours=hours))


@pytest.fixture()
def run(spark, scratch):
    return MarkedRaces(spark, scratch("marked"), schemas.RAW_RESULTS, wait="1 day")


def land(run, results, markers):
    run.spark.createDataFrame(results, LANDED).repartition(2).write.mode("append").parquet(run.rows_dir)
    run.spark.createDataFrame(markers, MARKERS).write.mode("append").parquet(run.markers_dir)
    run.trigger(staging.stage_results)


def staged(run):
    if not run.target.exists():
        return []
    return sorted((r.round_number, r.driver_code) for r in run.target.read().collect())


def rejected(run):
    return sorted((r["round"] or 0, r.driver_code, r.reason) for r in run.rejected.read().collect())


def test_a_race_over_three_triggers_is_staged_once_whole(spark, run):
    results = [result(r, f"D{i}", i) for r in (1, 2) for i in range(3)]
    for i in range(3):
        # the marker of race 2 is there before its last rows
        land(run, [x for x in results if x[4] == f"D{i}"], {0: [], 1: [marker(2, 3, 3)], 2: [marker(1, 3, 3)]}[i])
        assert staged(run) == ([] if i < 2 else [(r, f"D{j}") for r in (1, 2) for j in range(3)])
        if i == 1:
            assert sorted(r["round"] for r in run.held.read().collect()) == [2, 2]
    assert run.held.read().count() == 0 and rejected(run) == []
    whole = spark.createDataFrame([x[:-1] for x in results], schemas.RAW_RESULTS)
    assert rows(run.target.read()) == rows(staging.stage_results(whole))


def test_late_and_unmarked_rows_are_rejected_with_a_reason(run):
    land(run, [result(1, "A", 0), result(2, "B", 0), result(None, "N", 0)], [marker(1, 1, 1), marker(1, 1, 1)])
    assert staged(run) == [(1, "A")]
    land(run, [result(1, "C", 0.5)], [marker(1, 1, 1)])  # of a race that was staged; the marker once more
    assert staged(run) == [(1, "A")] and rejected(run) == [(1, "C", "late")]
    # days later the watermark has passed all that race 2 could wait for
    land(run, [result(3, "D", 100)], [marker(3, 1, 101)])
    land(run, [result(4, "E", 200)], [marker(4, 1, 201)])
    assert staged(run) == [(1, "A"), (3, "D"), (4, "E")]
    assert {(2, "B", "unmarked"), (1, "C", "late"), (0, "N", "unmarked")} <= set(rejected(run))


def test_a_batch_delivered_again_changes_nothing(spark, run):
    fields = "year int, round int, event_name string, driver_number string, driver_code string, full_name string, team string, " \
             "position double, points double, status string, landed_at timestamp, expected bigint"
    batch = lambda *rs: spark.createDataFrame(list(rs), fields)
    first = batch((*result(1, "A", 0), 2), (*result(2, "B", 0), 1), (*result(3, "C", 0), None))
    run.apply(first, 0, staging.stage_results)
    run.apply(first, 0, staging.stage_results)
    assert staged(run) == [(2, "B")] and [r.driver_code for r in run.held.read().collect()] == ["A"]
    # died after the staging commit, before the held table's
    second = batch((*result(1, "D", 0), 2), (*result(2, "E", 0), 1))
    held = run.held
    run.held = type("Dead", (), {"exists": held.exists, "commits": held.commits, "read": held.read})()
    with pytest.raises(AttributeError):
        run.apply(second, 1, staging.stage_results)
    assert staged(run) == [(1, "A"), (1, "D"), (2, "B")]
    run.held = held
    run.apply(second, 1, staging.stage_results)
    run.apply(second, 1, staging.stage_results)
    assert staged(run) == [(1, "A"), (1, "D"), (2, "B")] and held.read().count() == 0
    assert rejected(run) == [(2, "E", "late"), (3, "C", "unmarked")]


def test_the_state_holds_groups_of_rows_and_not_the_rows(spark, scratch, run):
    run.rows_dir = scratch("a folder of 100%")
    land(run, [result(1, f"D{i}", 0) for i in range(500)], [])
    state = spark.read.format("statestore").option("joinSide", "left").load(f"{run.root}/_checkpoint")
    assert 1 <= state.count() <= 2  # one race, one time, two files
    land(run, [result(1, "E", 1), result(None, "N", 1)], [marker(1, 501, 2)])
    assert len(staged(run)) == 501 and run.held.read().count() == 0
