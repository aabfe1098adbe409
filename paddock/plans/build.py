"""``build_all``: one application for the whole medallion flow of a landed batch.

    landing frames -> coerced and checked -> raw (season replace for the calendar, append of unseen
    rounds for results and laps) -> staging (incremental, NOT IN on the race key) -> marts (the
    landed seasons rebuilt) -> expectations

All tables are ``VersionedTable``s under one warehouse folder (by default inside the session's shared
checkpoint folder), partitioned by season. Marts are rebuilt from the staging tables as written,
so each layer is read back from storage and the lineage of a run is cut at every layer: a lost
executor re-runs at most one layer's tasks. Running the same batch twice adds nothing (idempotent).
A landing that would lose or mangle rows (no season or round, a round that does not fit the race key,
a race without a calendar row) fails before anything is written.
Control returns to the driver only between layers (writes), for the seasons of a landing, the one-row
facts of the NOT IN rule and the expectation report; no data passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions.columns import iso_date, race_id
from paddock.operators import expectations as ex
from paddock.operators import incremental as inc
from paddock.plans import marts, staging
from paddock.session import scratch_dir, stored
from paddock.sinks.tables import VersionedTable
from paddock.sources import bindings as b
from paddock.sources.readers import conform


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    report: DataFrame | None = None
    _tables: dict = field(default_factory=dict)

    def table(self, name: str, partition_by=(), order_by=()) -> VersionedTable:
        """One table object per name, so its log is read once and reused across layers."""
        if name not in self._tables:
            self._tables[name] = VersionedTable(self.spark, f"{self.root}/{name}", partition_by, order_by)
        return self._tables[name]

    @property
    def raw_races(self):
        return self.table("raw_races", ["year"])

    @property
    def raw_results(self):
        return self.table("raw_results", ["year"])

    @property
    def raw_fastest_laps(self):
        return self.table("raw_fastest_laps", ["year"])

    @property
    def stg_races(self):
        return self.table("stg_races", ["season_year"])

    @property
    def stg_results(self):
        return self.table("stg_results", ["season_year"])

    @property
    def stg_fastest_laps(self):
        return self.table("stg_fastest_laps", ["season_year"])

    def mart(self, name: str) -> VersionedTable:
        return self.table(name, ["season_year"], ORDER[name])


def landing_from_testdata(spark: SparkSession, sf_dir: str, batch: int, facts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The landed frames of cumulative batch ``batch`` built from the test tables; with ``facts`` (``landed_facts``, stored)
    the line items are not joined again."""
    results = conform(b.results_like(spark, sf_dir, facts).where(b.upto_batch(batch)), schemas.RAW_RESULTS)
    laps = b.laps_like(spark, sf_dir, facts).where(b.upto_batch(batch))
    races = b.races_like(spark, sf_dir, b.orders_in_batch(spark, sf_dir, batch)).withColumn("date", iso_date("date"))
    return {"raw_races": conform(staging.exclude_testing_events(races), schemas.RAW_RACES),
            "raw_results": results,
            "raw_fastest_laps": staging.pick_fastest_lap(laps, tiebreak=b.LAP_TIEBREAKS)}


def calendar_of(wh: Warehouse, landed: DataFrame) -> DataFrame:
    """The calendar a landing refers to: the landed one, and the stored one of seasons it does not hold."""
    calendar = landed.select("year", "round", "event_name")
    if wh.raw_races.exists():
        stored_races = wh.raw_races.read().select("year", "round", "event_name")
        calendar = calendar.unionByName(stored_races.join(landed.select("year").distinct(), "year", "left_anti"))
    return calendar


def prepare(wh: Warehouse, landing: dict[str, DataFrame], season: int | None = None) -> dict[str, DataFrame]:
    """Landed frames as raw rows: testing events out, missing text '' and NaN null in results, their event
    name from the calendar, lap times in seconds. With ``season``, rows that carry no year of their own get it (P10).

    The calendar is written once, so that its file size plans the join with the results."""
    out = dict(landing)
    if season is not None:
        out = {n: df.withColumn("year", F.coalesce("year", F.lit(season))) for n, df in out.items()}
    out = {n: staging.exclude_testing_events(df) for n, df in out.items()}
    calendar = stored(calendar_of(wh, out["raw_races"]), "calendar")
    check_landing(out, calendar)
    out["raw_results"] = conform(staging.coerce_results(out["raw_results"], calendar), schemas.RAW_RESULTS)
    out["raw_fastest_laps"] = conform(staging.coerce_laps(out["raw_fastest_laps"]), schemas.RAW_FASTEST_LAPS)
    return out


def check_landing(landing: dict[str, DataFrame], calendar: DataFrame) -> None:
    """Raise unless every landed row has a season and a round that fits the race key, and a race of the
    calendar."""
    parts = []
    for name, df in landing.items():
        parts.append(ex.not_null_counts(df, name, ["year", "round"]))
        long_rounds = ex.round_fits_key(df).agg(F.count(F.lit(1)).alias("violations"))
        races = df.where("year IS NOT NULL AND round IS NOT NULL").select("year", "round").distinct()
        strange = races.join(calendar, ["year", "round"], "left_anti").agg(F.count(F.lit(1)).alias("violations"))
        for test, counted in (("round_fits_key", long_rounds), ("relationships", strange)):
            parts.append(counted.select(F.lit(test).alias("test_name"), F.lit(name).alias("table_name"),
                                        F.lit("round").alias("column_name"), "violations"))
    ex.assert_passed(reduce(DataFrame.unionByName, parts))


def land(wh: Warehouse, landing: dict[str, DataFrame], seasons) -> None:
    """Raw layer, for the listed seasons: a landed calendar replaces the season's; results and laps only gain
    rounds they did not have. Landed rows of other seasons wait for their own run."""
    races, calendar = wh.raw_races, landing["raw_races"].where(F.col("year").isin(list(seasons)))
    if not races.exists():
        races.create_empty(landing["raw_races"])
    replaced = _years(calendar)
    if replaced:
        races.replace_partitions(calendar, replaced)
    for name in ("raw_results", "raw_fastest_laps"):
        t = getattr(wh, name)
        t.append(inc.append_unseen(t, landing[name], keys=("year", "round"), seasons=seasons))


def _seasons(df: DataFrame, col: str, seasons) -> DataFrame:
    return df if seasons is None else df.where(F.col(col).isin(list(seasons)))


def stage(wh: Warehouse, seasons=None) -> None:
    """Staging layer. With ``seasons`` only those raw partitions are read (partition pruning): every
    run stages what it lands, so older seasons hold no unstaged race. ``None`` scans everything."""
    key = race_id("year", "round")
    for target, raw, fn in ((wh.stg_races, wh.raw_races, staging.stage_races),
                            (wh.stg_results, wh.raw_results, staging.stage_results),
                            (wh.stg_fastest_laps, wh.raw_fastest_laps, staging.stage_fastest_laps)):
        inc.incremental_stage(target, _seasons(raw.read(), "year", seasons), fn, key, seasons=seasons, dealt_by="year")


#: The marts, and what orders the rows of a season in the stored files (O1).
ORDER = {"driver_standings": ["championship_position"], "team_performance": ["constructors_position"],
         "fastest_laps_enriched": ["round_number"]}
MARTS = tuple(ORDER)


def build_marts(wh: Warehouse, seasons=None) -> None:
    """Mart layer; the jobs that write the marts count the violations of their not-null tests. Every mart's window is partitioned by season, so rebuilding only the seasons of a
    landing (replacing those partitions) gives the same table as a full rebuild at a cost that grows
    with the landing, not with history. ``None`` rebuilds everything."""
    results = _seasons(wh.stg_results.read(), "season_year", seasons)
    built = {"driver_standings": marts.driver_standings(results),
             "team_performance": marts.team_performance(results),
             "fastest_laps_enriched": marts.fastest_laps_enriched(
                 _seasons(wh.stg_fastest_laps.read(), "season_year", seasons), wh.stg_races.read())}
    for name in MARTS:
        t, observe = wh.mart(name), ex.null_counters(name)
        if seasons is None or not t.exists():
            t.overwrite(built[name], observe=observe)
        else:
            t.replace_partitions(built[name], list(seasons), observe=observe)


# every staged race is in the calendar (child table, column, parent table, column)
RELATIONSHIPS = (("stg_results", "race_id", "stg_races", "race_id"), ("stg_fastest_laps", "race_id", "stg_races", "race_id"))


def check(wh: Warehouse, raise_on_failure: bool = True) -> DataFrame:
    """The expectation report of the stored tables, computed once; one row per test. Not-null tests of marts whose
    writes counted no violation need no scan."""
    tables = {n: wh.mart(n).read() for n in MARTS}
    tables |= {n: getattr(wh, n).read() for n in ("stg_races", "stg_results", "stg_fastest_laps")}
    counts = {(t, c): wh.mart(t).observed_total(c) for t, c in ex.NOT_NULL_TESTS}
    known = {k: v for k, v in counts.items() if v is not None}
    report = stored(ex.report(tables, relationships=RELATIONSHIPS, known=known), "report")
    return ex.assert_passed(report) if raise_on_failure else report


def build_all(spark: SparkSession, landing: dict[str, DataFrame], seasons=None, warehouse=None,
              raise_on_failure: bool = True, season: int | None = None) -> Warehouse:
    """Build the listed seasons (default: all that the landing holds) into ``warehouse``; its ``report`` is that
    of the run."""
    wh = warehouse if isinstance(warehouse, Warehouse) else Warehouse(spark, warehouse or scratch_dir(spark, "warehouse"))
    landing = prepare(wh, landing, season)
    seasons = list(seasons) if seasons else seasons_of(landing)
    land(wh, landing, seasons)
    stage(wh, seasons)
    build_marts(wh, seasons)
    wh.report = check(wh, raise_on_failure)
    return wh


def _years(df: DataFrame) -> list[int]:
    return [r.year for r in df.select("year").where("year IS NOT NULL").distinct().orderBy("year").collect()]


def seasons_of(landing: dict[str, DataFrame]) -> list[int]:
    """Seasons present in any landed table (bounded by the calendar)."""
    return _years(reduce(DataFrame.unionByName, [df.select("year") for df in landing.values()]))


def warehouse_driver_standings(spark: SparkSession, sf_dir: str, warehouse: str | None = None) -> DataFrame:
    """End-to-end: three landed batches through ``build_all``; the driver standings mart as stored.

    A build reads its landing several times (checks, seasons, rows). The joined line items are written once, and the
    batches are ranges of order dates of them; calendar and fastest laps, one row per race, are written per batch."""
    facts = stored(b.landed_facts(spark, sf_dir), "landed-facts")
    wh = Warehouse(spark, warehouse or scratch_dir(spark, "warehouse"))
    for k in (1, 2, 3):
        landing = landing_from_testdata(spark, sf_dir, k, facts)
        landing |= {name: stored(landing[name], name) for name in ("raw_races", "raw_fastest_laps")}
        build_all(spark, landing, warehouse=wh)
    return wh.mart("driver_standings").read()
