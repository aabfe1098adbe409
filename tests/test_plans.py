"""Plan properties that the design relies on at scale, checked on the physical plans."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from paddock.plans import maintenance as mt
from paddock.operators.ranking import distributed_row_number
from paddock.sources import bindings as b

from .conftest import SF_SMALL


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def test_top_k_limits_before_the_shuffle(spark):
    for name in ("top10_drivers", "top5_laps", "q_most_wins"):
        assert "WindowGroupLimit" in executed(E.queries()[name](spark, SF_SMALL)), name


def exchanges(df) -> list[str]:
    """Of each hash exchange in the final plan, the operator below it."""
    lines = [x for x in executed(df).splitlines() if "InputAdapter" not in x and "WholeStageCodegen" not in x]
    return [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "Reused" not in x]


def test_running_sum_moves_the_rows_once(spark):
    below = exchanges(E.queries()["cumulative_points"](spark, SF_SMALL))
    rows_moved = [x for x in below if "partial_sum" not in x and "_chunk_sum" not in x and "Aggregate" not in x and "Window" not in x]
    assert len(rows_moved) == 1, below


def test_running_sum_computes_its_input_once(spark):
    for name in ("cumulative_points", "cumulative_points_sparse", "points_evolution"):
        assert executed(E.queries()[name](spark, SF_SMALL)).count("lineitem.parquet") == 1, name


def test_fastest_laps_take_one_pass(spark):
    for name in ("stage_fastest_laps", "pick_fastest_lap", "fastest_laps_enriched"):
        plan = executed(E.queries()[name](spark, SF_SMALL))
        assert plan.count("lineitem.parquet") == 1 and "SortAggregate" not in plan and "WindowGroupLimit" in plan, name


def test_standings_start_no_job_and_prune_by_season(spark, scratch):
    from paddock.plans import marts, models

    sc = spark.sparkContext

    def jobs(name, build):
        sc.setJobGroup(name, name)
        try:
            build(spark, SF_SMALL)
            return len(sc.statusTracker().getJobIdsForGroup(name))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    # reading the footers of the tables starts jobs, the numbering none
    assert jobs("standings", E.queries()["driver_standings"]) == jobs("staged", models.stg_results)
    from paddock.sinks.tables import VersionedTable

    t = VersionedTable(spark, scratch("stg"), partition_by=["season_year"])
    t.overwrite(models.stg_results(spark, SF_SMALL))
    plan = executed(marts.driver_standings(t.read().where("season_year = 1996")))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert scans and all("season_year" in x for x in scans)


def test_top_k_queries_skip_the_numbering(spark):
    for name in ("top10_drivers", "q_most_wins", "q_most_finishes"):
        assert "WindowGroupLimit" in executed(E.queries()[name](spark, SF_SMALL)), name
    assert "Window" not in executed(E.queries()["q_driver_podiums"](spark, SF_SMALL))


def test_batch_cut_reaches_the_orders_scan(spark):
    plan = executed(b.results_like(spark, SF_SMALL).where(b.upto_batch(1)))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", plan)


def test_scans_read_only_needed_columns(spark):
    plan = executed(E.queries()["driver_standings"](spark, SF_SMALL).select("season_year"))
    columns = " ".join(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert "l_suppkey" in columns and "l_extendedprice" not in columns and "l_comment" not in columns
    plan = executed(E.queries()["stage_races"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("o_totalprice" not in s and "c_acctbal" not in s for s in schemas)


def test_versioned_table_reads_in_one_scan(spark, scratch):
    plan = executed(mt.replace_season(spark, SF_SMALL, scratch("one")))
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    assert "PartitionFilters: [" in plan and "vt_part" in plan


def test_numbering_is_gapless_when_one_group_holds_most_rows(spark):
    # season 0 holds 90% of the rows and is spread over its buckets
    df = spark.range(0, 5000).select(F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("season"),
                                     (F.col("id") % 7).cast("double").alias("pts"), F.col("id").alias("k"))
    out = distributed_row_number(df, ["season"], [("pts", True)], [F.col("pts").desc(), F.col("k")], "rn")
    stats = {r.season: (r.n, r.lo, r.hi, r.d) for r in out.groupBy("season").agg(
        F.count(F.lit(1)).alias("n"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
        F.count_distinct("rn").alias("d")).collect()}
    assert stats == {0: (4500, 1, 4500, 4500), 1: (500, 1, 500, 500)}


def test_race_keys_do_not_shuffle_the_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        for name in ("coerce_results", "incremental_not_in"):
            df = E.queries()[name](spark, SF_SMALL)
            assert not [x for x in exchanges(df) if "year" in x and "round" in x], name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
