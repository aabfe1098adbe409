"""Multi-step table maintenance runs over the test tables.

Each function performs real writes — one Spark job per step — into a fresh directory under the
session's shared checkpoint folder, then returns the final table as a lazy read. The landing
batches are the three cumulative order batches of ``bindings.BATCH_CUTS``; each step is the run the
original would make when that batch had landed. The number of steps is fixed by the fixture (3 batches,
a handful of seasons, one snapshot per season), never by data volume; each step is distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions.columns import race_id, surrogate_key
from paddock.operators import incremental as inc
from paddock.operators import scd2
from paddock.plans import models, staging
from paddock.session import scratch_dir, stored
from paddock.sinks.tables import VersionedTable, export_csv
from paddock.sources import bindings as b
from paddock.sources.readers import conform, read_csv, read_seed_fastest_laps, read_seed_races

BATCHES = (1, 2, 3)
# First season re-ingested with a batch in ``replace_season`` (fixture parameter): the batch's own first season.
FIRST_REPLACED = {2: 1998, 3: 2000}
# Season that the first run of ``append_new_rounds`` does not list although its landing holds it.
UNLISTED_SEASON = 1996
# As-of dates of the driver/team snapshot runs, one after each batch.
SNAPSHOT_RUNS = (*b.BATCH_CUTS, "2002-01-01")


def _landed_results(spark, d) -> DataFrame:
    """What lands over all batches, joined and written once; a batch is a range of order dates of it."""
    rows = b.results_like(spark, d).select(*schemas.RAW_RESULTS.fieldNames(), "o_orderdate")
    return stored(rows, "landed-results")


def _landed_laps(spark, d) -> DataFrame:
    return stored(b.laps_like(spark, d), "landed-laps")


def _raw_results(spark, d, batch=None) -> DataFrame:
    r = b.results_like(spark, d)
    if batch is not None:
        r = r.where(b.upto_batch(batch))
    return r


def _raw_laps(spark, d, batch=None) -> DataFrame:
    laps = b.laps_like(spark, d)
    if batch is not None:
        laps = laps.where(b.upto_batch(batch))
    return staging.pick_fastest_lap(laps, tiebreak=b.LAP_TIEBREAKS)


def _raw_races(spark, d, batch=None) -> DataFrame:
    orders = None if batch is None else b.orders_in_batch(spark, d, batch)
    return b.races_like(spark, d, orders)


def schema_clone(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """K1: ``CREATE TABLE IF NOT EXISTS t AS SELECT * FROM df WHERE 1=0`` — twice, the second a no-op."""
    t = VersionedTable(spark, root or scratch_dir(spark, "schema_clone"))
    like = conform(b.results_like(spark, d), schemas.RAW_RESULTS)
    t.create_empty(like)
    t.create_empty(like)
    return t.read()


def replace_season(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """Load the batch-1 calendar; with each later batch replace its seasons' calendars (delete the seasons'
    rows, insert the new ones) in one commit. The batch's seasons are a date range on the orders scan; a
    season without orders in the batch ends up empty (T11) until a later batch fills it."""
    t = VersionedTable(spark, root or scratch_dir(spark, "raw_races"), partition_by=["year"])
    t.overwrite(_raw_races(spark, d, 1))
    last = max(b.order_years(spark, d), default=0)
    for k, first in FIRST_REPLACED.items():
        orders = b.orders_in_batch(spark, d, k).where(F.col("o_orderdate") >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
        t.replace_partitions(b.races_like(spark, d, orders), range(first, last + 1))
    return t.read()


def csv_round_trip(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """K4 + S3: export raw results as header CSV and read them back with the explicit schema."""
    path = (root or scratch_dir(spark, "csv")) + "/raw_results_csv"
    export_csv(conform(b.results_like(spark, d), schemas.RAW_RESULTS), path)
    return read_csv(spark, path, schemas.RAW_RESULTS)


def csv_round_trip_races(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """The calendar as a seed file, read back typed (its date is a DATE)."""
    path = (root or scratch_dir(spark, "csv")) + "/raw_races_csv"
    export_csv(conform(b.races_like(spark, d), schemas.SEED_RACES), path)
    return read_seed_races(spark, path)


def csv_round_trip_laps(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """The fastest laps as a seed file, read back typed."""
    path = (root or scratch_dir(spark, "csv")) + "/raw_fastest_laps_csv"
    export_csv(conform(_raw_laps(spark, d), schemas.RAW_FASTEST_LAPS), path)
    return read_seed_fastest_laps(spark, path)


def ingest_laps(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """X16 on the build path: landed laps carry their time as an interval; the raw table holds seconds."""
    from paddock.plans.build import Warehouse, land, prepare, seasons_of

    wh = Warehouse(spark, root or scratch_dir(spark, "ingest_laps"))
    landing = prepare(wh, b.landing_with_lap_times(spark, d))
    land(wh, landing, seasons_of(landing))
    return wh.raw_fastest_laps.read()


def incremental_not_in(spark: SparkSession, d: str) -> DataFrame:
    """Raw results of all batches whose race key is NOT IN the races staged from batch 1."""
    loaded = staging.stage_results(_raw_results(spark, d, 1)).select("race_id")
    raw = conform(_raw_results(spark, d), schemas.RAW_RESULTS).withColumn("race_id", race_id("year", "round"))
    return inc.not_in(raw, "race_id", loaded, "race_id")


def append_new_rounds(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """Per landed batch, append the result rows of rounds not yet in raw_results. Each run is about the
    seasons it lists: a landed season that it does not list waits for the next run."""
    t = VersionedTable(spark, root or scratch_dir(spark, "raw_results"), partition_by=["year"])
    years = b.order_years(spark, d)
    for k in BATCHES:
        landed = conform(_raw_results(spark, d, k), schemas.RAW_RESULTS)
        t.append(inc.append_unseen(t, landed, keys=("year", "round"), seasons=[y for y in years if k > 1 or y != UNLISTED_SEASON]))
    return t.read()


def _incremental(spark, root, name, raw_of, stage) -> DataFrame:
    t = VersionedTable(spark, root or scratch_dir(spark, name), partition_by=["season_year"])
    for k in BATCHES:
        inc.incremental_stage(t, raw_of(k), stage, race_id("year", "round"), dealt_by="year")
    return t.read()


def incremental_results(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """``stg_results`` built incrementally over the three batches."""
    landed = _landed_results(spark, d)
    return _incremental(spark, root, "stg_results", lambda k: conform(landed.where(b.upto_batch(k)), schemas.RAW_RESULTS),
                        staging.stage_results)


def incremental_races(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """``stg_races`` built incrementally (a race keeps the calendar row of its first batch)."""
    return _incremental(spark, root, "stg_races", lambda k: _raw_races(spark, d, k), staging.stage_races)


def incremental_laps(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """``stg_fastest_laps`` built incrementally (a race keeps the lap picked from its first batch)."""
    landed = _landed_laps(spark, d)
    return _incremental(spark, root, "stg_fastest_laps",
                        lambda k: staging.pick_fastest_lap(landed.where(b.upto_batch(k)), tiebreak=b.LAP_TIEBREAKS),
                        staging.stage_fastest_laps)


def upsert_by_key(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """I4: stage batch 1, then upsert the rows new in batch 2 and in batch 3 by ``result_sk``."""
    t = VersionedTable(spark, root or scratch_dir(spark, "upsert"), partition_by=["season_year"])
    landed = _landed_results(spark, d)

    def staged(k):
        return staging.stage_results(landed.where(b.in_batch(k)).hint("rebalance", F.col("year")))

    t.overwrite(staged(1), dealt=True)
    for k in BATCHES[1:]:
        inc.upsert_into(t, staged(k), "result_sk", "season_year", dealt=True,
                        key_of=surrogate_key("season_year", "round_number", "driver_code"))
    return t.read()


def _snapshot_source(spark, d, year=None) -> DataFrame:
    src = b.customer_priority_snapshots(spark, d, year)
    return src.select("snapshot_year", surrogate_key("o_custkey").alias("snapshot_sk"), "o_custkey", "o_orderpriority")


def _run_ts(year_col):
    return F.make_timestamp_ntz(year_col + F.lit(1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def scd2_history(spark: SparkSession, d: str, root: str | None = None, years=None) -> DataFrame:
    """I5 stepwise: one snapshot run per year (as of 1 January of the next year), check strategy on
    the customer's latest order priority. The run list is the distinct years (one per season), or ``years``."""
    t = VersionedTable(spark, root or scratch_dir(spark, "snapshot"), partition_by=["dbt_valid_to"])
    # one run per calendar year between the first and last order; a year without orders is a run
    # with an empty source, which changes nothing (vanished keys stay open)
    for y in b.order_years(spark, d) if years is None else years:
        run = _snapshot_source(spark, d, y).drop("snapshot_year")
        scd2.snapshot_step(t, run, "snapshot_sk", ["o_orderpriority"], _run_ts(F.lit(y)))
    return scd2.versions(t)


def scd2_late_runs(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """I5 with late and repeated runs: every second year first, the first of them once more, then the years between
    from the last to the first. Equal to ``scd2_history``."""
    years = b.order_years(spark, d)
    return scd2_history(spark, d, root, [*years[::2], *years[:1], *reversed(years[1::2])])


def scd2_current(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    return scd2.current(scd2_history(spark, d, root))


def scd2_closed_form(spark: SparkSession, d: str) -> DataFrame:
    """I5 batch form over all runs at once (gaps and islands) — equal to ``scd2_history``."""
    src = _snapshot_source(spark, d)
    return scd2.history(src, "snapshot_sk", ["o_orderpriority"], "snapshot_year", _run_ts(F.col("snapshot_year")))


def scd2_driver_team(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """K8/I5 on drivers and teams: after each batch, one snapshot run over the staged results, check strategy on
    the team. A driver who moved within a season has that of the latest row (``latest_per_key``)."""
    t = VersionedTable(spark, root or scratch_dir(spark, "driver_team"), partition_by=["dbt_valid_to"])
    for k, ts in zip(BATCHES, SNAPSHOT_RUNS):
        raw = b.transfers_like(spark, d).where(b.upto_batch(k))
        staged = staging.stage_results(raw, keep=("l_orderkey", "l_linenumber"))
        latest = scd2.latest_per_key(staged, ["driver_code", "season_year"], ["team_name"], ["round_number", "l_orderkey", "l_linenumber"])
        source = latest.withColumn("driver_team_sk", surrogate_key("driver_code", "season_year"))
        scd2.snapshot_step(t, source, "driver_team_sk", ["team_name"], F.lit(ts).cast("timestamp_ntz"))
    return scd2.versions(t)


def places(t: VersionedTable, group: str, order: str) -> DataFrame:
    """The table's rows with ``stored_place``: a row's place among the rows of its ``group`` (the partition), as the files
    hold them, files one after the other by their least ``order``. Counts per file give the rows before each."""
    rows = t.read_placed()
    files = rows.groupBy(F.col(group).alias("_group"), F.col("_file").alias("_in")).agg(F.min(order).alias("_least"), F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy(F.col("_least").asc_nulls_first(), "_in").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_group", "_in", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(files, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_file") == F.col("_in")))
            .withColumn("stored_place", F.col("_before") + F.col("_row") + 1).drop("_group", "_in", "_file", "_row", "_before"))


def stored_order(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """O1: the driver standings as the build stores them, each row with its place in the stored files of its season."""
    from paddock.plans.build import Warehouse

    t = Warehouse(spark, root or scratch_dir(spark, "stored_order")).mart("driver_standings")
    t.overwrite(models.driver_standings(spark, d))
    return places(t, "season_year", t.order_by[0]).select("season_year", "driver_code", "total_points", "championship_position", "stored_place")


def ingest_results(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """J7, F9, X17, X18 on the build path: the results that a landing with gaps leaves in the raw table."""
    from paddock.plans.build import Warehouse, land, prepare, seasons_of

    wh = Warehouse(spark, root or scratch_dir(spark, "ingest"))
    landing = prepare(wh, b.landing_with_gaps(spark, d))
    land(wh, landing, seasons_of(landing))
    return wh.raw_results.read()


def stream_incremental_results(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """I2 as a stream: each batch's new rows land as files, then one ``availableNow`` trigger stages
    them into the versioned target through ``foreachBatch``."""
    from paddock.streaming.incremental import stream_incremental_stage

    root = root or scratch_dir(spark, "stream")
    target = VersionedTable(spark, f"{root}/stg_results", partition_by=["season_year"])
    raw = _landed_results(spark, d)
    for k in BATCHES:
        conform(raw.where(b.in_batch(k)), schemas.RAW_RESULTS).write.mode("append").parquet(f"{root}/landing")
        stream_incremental_stage(spark, f"{root}/landing", schemas.RAW_RESULTS, target, staging.stage_results,
                                 race_id("year", "round"), f"{root}/_checkpoint", dealt_by="year")
    return target.read()


def stream_marked_races(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """Section 2.14 with a marker of complete races: every race's rows land spread over three triggers, its marker with
    one of them, some before the race's last rows; each race is staged once, whole."""
    from paddock.streaming.marked import MARKERS, MarkedRaces, landed_schema

    root = root or scratch_dir(spark, "stream_marked")
    run = MarkedRaces(spark, root, schemas.RAW_RESULTS)
    landing = b.landing_in_thirds(spark, d)
    markers = stored(b.race_markers(spark, d), "markers")
    for k in range(3):
        conform(landing.where(F.col("_third") == k), landed_schema(schemas.RAW_RESULTS)).write.mode("append").parquet(run.rows_dir)
        conform(markers.where(F.col("_third") == k), MARKERS).write.mode("append").parquet(run.markers_dir)
        run.trigger(staging.stage_results)
    return run.target.read()
