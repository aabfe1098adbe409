"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the test tables in ``sf_dir`` (or data Spark derives from them) and runs over the
whole tables: dashboard queries that the original runs for one season run for all seasons at once.
Column names equal those of the matching oracle in ``paddock.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.columns import (
    classify_position,
    format_lap_time,
    race_id,
    round_half_away,
    surrogate_key,
    to_int,
)
from paddock.operators import expectations as ex
from paddock.operators.ranking import sorted_values
from paddock.operators.running import running_sum
from paddock.plans import adhoc, analytics as an, marts, models, staging
from paddock.session import stored, stored_observed
from paddock.sources import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _cum(spark, d):
    return an.cumulative_points(models.stg_results(spark, d, keep=b.RESULT_TIEBREAKS), tiebreak=b.RESULT_TIEBREAKS,
                                block_first_tiebreak=True)


# --- staging and marts ---------------------------------------------------------------------------
register("driver_standings")(models.driver_standings)
register("team_performance")(models.team_performance)
register("fastest_laps_enriched")(models.fastest_laps_enriched)
register("stage_results")(lambda spark, d: models.stg_results(spark, d))
register("stage_races")(models.stg_races)
register("stage_fastest_laps")(models.stg_fastest_laps)
register("pick_fastest_lap")(models.raw_fastest_laps)


# --- scalar functions ----------------------------------------------------------------------------
@register("race_key")
def race_key(spark, d):
    return models.raw_races(spark, d).select("year", "round", race_id("year", "round").alias("race_id"))


@register("cast_position")
def cast_position(spark, d):
    raw = F.col("l_quantity") / F.lit(4.0)
    return b.table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select(
        "l_orderkey", "l_linenumber", raw.alias("position_raw"), to_int(raw).alias("finish_position"))


@register("format_lap_time")
def format_lap_time_q(spark, d):
    s = round_half_away("lap_time_seconds", 3)
    return b.laps_like(spark, d).select("l_orderkey", "l_linenumber", s.alias("lap_time_seconds"),
                                        format_lap_time(s).alias("lap_time_formatted"))


@register("classify_position")
def classify_position_q(spark, d):
    return models.stg_results(spark, d, keep=("l_orderkey", "l_linenumber")).select(
        "l_orderkey", "l_linenumber", "finish_position", classify_position("finish_position").alias("position_label"))


@register("surrogate_key")
def surrogate_key_q(spark, d):
    return models.raw_results(spark, d).select(
        "year", "round", "driver_code", surrogate_key("year", "round", "driver_code").alias("result_sk"))


@register("coerce_results")
def coerce_results_q(spark, d):
    f = b.line_facts(spark, d, ("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"))
    landed = f.select(
        "year", "round",
        F.col("l_suppkey").alias("driver_number"),
        F.col("s_name").alias("driver_code"),
        F.concat(F.lit("Driver "), F.col("s_name")).alias("full_name"),
        F.col("n_name").alias("team"),
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan")))
         .otherwise(F.ceil(F.col("l_quantity") / F.lit(2.5)).cast("double")).alias("position"),
        (F.lit(51.0) - F.col("l_quantity")).alias("points"),
        F.when(F.col("l_linestatus") == "F", "Finished").otherwise("Retired").alias("status"))
    # one row per race: written once, so that its file size plans the join
    return staging.coerce_results(landed, stored(models.raw_races(spark, d), "calendar"))


# --- dashboard -----------------------------------------------------------------------------------
register("season_slice")(lambda spark, d: an.season_slice(models.driver_standings(spark, d)))
register("top10_drivers")(lambda spark, d: an.top10_drivers(models.driver_totals(spark, d),
                                                            b.team_colours_like(spark, d)))
# the dashboard's bound parameter, one season (a value that the test tables hold)
BOUND_SEASON = 1996
register("season_slice_bound")(lambda spark, d: an.season_slice(
    marts.driver_standings(models.stg_results(spark, d).where(F.col("season_year") == BOUND_SEASON)), BOUND_SEASON))
register("cumulative_points")(_cum)


@register("cumulative_points_events")
def cumulative_points_events(spark, d):
    # chunk = the event's hour: monotone in (ts, event_id), so a hot user is split into hourly blocks
    # and the offsets window per user sees at most one row per hour of the calendar
    out = running_sum(b.events_values(spark, d), ["user_id"], ["ts", "event_id"], "value_dec", "running_value", chunk=F.date_trunc("hour", "ts"))
    return out.select("user_id", "ts", "event_id", "value", F.col("running_value").cast("double").alias("running_value"))


@register("cumulative_points_sparse")
def cumulative_points_sparse(spark, d):
    # rounds that are missing come last, as one block; points in tenths, which binary numbers do not hold
    rows = (b.results_like(spark, d)
            .withColumn("round", F.when(F.col("l_linenumber") != 1, F.col("round")))
            .withColumn("points", F.col("l_quantity") / F.lit(10.0)))
    return an.cumulative_points(staging.stage_results(rows, keep=b.RESULT_TIEBREAKS), tiebreak=b.RESULT_TIEBREAKS)


register("points_evolution")(lambda spark, d: an.points_evolution(_cum(spark, d), models.stg_races(spark, d)))
register("axis_labels")(lambda spark, d: an.axis_labels(models.stg_races(spark, d)))


@register("compare_selected")
def compare_selected(spark, d):
    cum = _cum(spark, d)
    evo = an.points_evolution(cum, models.stg_races(spark, d))
    return an.compare_selected(evo, an.default_driver_selection(cum))


# The first team needs the rows of the running-total frame, not its values: read the staged rows.
register("first_team_per_driver")(lambda spark, d: an.first_team_per_driver(
    models.stg_results(spark, d, keep=b.RESULT_TIEBREAKS), b.team_colours_like(spark, d), tiebreak=b.RESULT_TIEBREAKS))
register("final_points")(lambda spark, d: an.final_points(_cum(spark, d)))
# Sorted lists of a selection; the place is a column, because stored rows have no order
register("distinct_sorted")(lambda spark, d: sorted_values(models.stg_results(spark, d), ["season_year"], "driver_name", "place"))
register("seasons_descending")(lambda spark, d: sorted_values(models.stg_races(spark, d), [], "season_year", "place", descending=True))
register("season_laps")(lambda spark, d: an.season_laps_table(models.fastest_laps_enriched(spark, d)))
register("lap_axis_bounds")(lambda spark, d: an.lap_axis_bounds(models.fastest_laps_enriched(spark, d)))
register("top5_laps")(lambda spark, d: an.top5_laps(models.fastest_laps_enriched(spark, d)))
register("team_history")(lambda spark, d: an.team_history(models.team_performance(spark, d)))
register("team_compare")(lambda spark, d: an.team_compare(an.team_history(models.team_performance(spark, d)),
                                                          b.team_colours_like(spark, d)))
register("team_colour_lookup")(lambda spark, d: an.team_colour_lookup(models.team_performance(spark, d),
                                                                      b.team_colours_like(spark, d)))


@register("distinct_driver_teams")
def distinct_driver_teams(spark, d):
    r = models.stg_results(spark, d)
    return (r.select("driver_code", "driver_name", "season_year", "team_name").distinct()
            .select(surrogate_key("driver_code", "season_year").alias("driver_team_sk"),
                    "driver_code", "driver_name", "season_year", "team_name"))


@register("load_summary")
def load_summary(spark, d):
    parts = [("raw_races", models.raw_races(spark, d)), ("raw_results", models.raw_results(spark, d)),
             ("raw_fastest_laps", models.raw_fastest_laps(spark, d))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


# --- questions -----------------------------------------------------------------------------------
register("q_most_wins")(lambda spark, d: an.q_most_wins(models.driver_totals(spark, d)))
register("q_most_points_team")(lambda spark, d: an.q_most_points_team(models.team_performance(spark, d)))
register("q_fastest_lap_overall")(lambda spark, d: an.q_fastest_lap_overall(models.stg_fastest_laps(spark, d), models.stg_races(spark, d)))
register("q_driver_podiums")(lambda spark, d: an.q_driver_podiums(models.driver_totals(spark, d)))
register("q_most_finishes")(lambda spark, d: an.q_most_finishes(models.driver_totals(spark, d)))

# Fixed example question for the guarded ad-hoc path (its oracle is the same text on DuckDB).
ADHOC_EXAMPLE = ("SELECT season_year, driver_name, team_name, wins FROM driver_standings "
                 "WHERE championship_position <= 3")


@register("adhoc_sql")
def adhoc_sql(spark, d):
    views = {"driver_standings": models.driver_standings(spark, d),
             "team_performance": models.team_performance(spark, d),
             "fastest_laps_enriched": models.fastest_laps_enriched(spark, d)}
    df, err = adhoc.run_adhoc(spark, ADHOC_EXAMPLE, views)
    if err:
        raise RuntimeError(err)
    return df


# --- expectations --------------------------------------------------------------------------------
def _stored_marts(spark, d):
    """The tables under test as the build stores them, each derived once, and the violations of their not-null tests
    that the jobs which wrote them counted."""
    staged = stored(models.stg_results(spark, d), "stg_results")
    tables, known = {"stg_results": staged}, {}
    for n, df in {"driver_standings": marts.driver_standings(staged), "team_performance": marts.team_performance(staged),
                  "fastest_laps_enriched": models.fastest_laps_enriched(spark, d)}.items():
        tables[n], counts = stored_observed(df, n, ex.null_counters(n))
        known |= {(n, c): v for c, v in counts.items()}
    return tables, known


@register("expect_not_null")
def expect_not_null(spark, d):
    tables, known = _stored_marts(spark, d)
    return ex.report(tables, unique=(), known=known)


register("expect_unique_combination")(lambda spark, d: ex.unique_combination(
    b.table(spark, d, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]))
register("expect_relationship")(lambda spark, d: ex.relationship(
    models.stg_results(spark, d), "team_name", b.team_colours_like(spark, d), "team"))


@register("expectation_report")
def expectation_report(spark, d):
    tables, known = _stored_marts(spark, d)
    tables["team_colours"] = b.team_colours_like(spark, d)
    return ex.report(tables, relationships=(("stg_results", "team_name", "team_colours", "team"),), known=known)


# --- table maintenance (multi-step writes under the shared checkpoint folder) ----------------------
from paddock.plans import maintenance as mt  # noqa: E402

for _name in ("schema_clone", "replace_season", "csv_round_trip", "csv_round_trip_races", "csv_round_trip_laps", "ingest_laps", "incremental_not_in", "append_new_rounds",
              "incremental_races", "incremental_results", "incremental_laps", "upsert_by_key",
              "scd2_history", "scd2_current", "scd2_late_runs", "scd2_driver_team", "ingest_results", "stored_order"):
    register(_name)(getattr(mt, _name))
register("stream_incremental_results")(mt.stream_incremental_results)
register("stream_marked_races")(mt.stream_marked_races)


@register("warehouse_driver_standings")
def warehouse_driver_standings(spark, d):
    from paddock.plans.build import warehouse_driver_standings as run
    return run(spark, d)
