"""Dashboard and question-answering queries (D1-D10, H2-H6) over the marts and staging tables.

The originals run one season at a time with a bound parameter; here every function takes an optional
``season`` (``None`` = all seasons at once, the season becoming part of every group key). On the
stored staging and mart tables, which are partitioned by season, the filter is a partition filter
(only that season's files are listed and read). Presentation aliases (``#``, ``Año``...) are kept as in the original.
Selections made with widgets (first two drivers, first six teams) are computed as top-k per season
and applied with a semi join, never collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.columns import exact_points, points_label, round_half_away, short_event_name
from paddock.operators.lookup import lookup_with_default
from paddock.operators.ranking import asc, desc, first_n_distinct, first_value_by, top_k, top_k_per_group
from paddock.operators.running import running_sum
from paddock.plans.marts import championship_order, fastest_laps_enriched
from paddock.sources.bindings import DEFAULT_COLOUR


def _season(df: DataFrame, season, col="season_year") -> DataFrame:
    return df if season is None else df.where(F.col(col) == F.lit(season))


def _in_order(df: DataFrame, season, *order) -> DataFrame:
    """One season is shown in order (O2); over all seasons a stored result has no row order."""
    return df if season is None else df.orderBy(*order)


# -- D1 / D2: drivers page ----------------------------------------------------------------------
def season_slice(standings: DataFrame, season=None) -> DataFrame:
    return _in_order(_season(standings, season).select(
        "season_year",
        F.col("championship_position").alias("#"),
        F.col("driver_name").alias("Piloto"),
        F.col("team_name").alias("Equipo"),
        F.col("total_points").alias("Puntos"),
        F.col("wins").alias("Victorias"),
        F.col("podiums").alias("Podios"),
        F.col("races_entered").alias("Carreras"),
        round_half_away("avg_finish_position", 1).alias("Pos_Media")), season, asc("#"))


def top10_drivers(totals: DataFrame, colours: DataFrame, season=None) -> DataFrame:
    """Ten best of each season in championship order, with the team colour (default if none). The first k places
    need no numbering of the rest: each task forwards its ten best per season."""
    ranked = top_k_per_group(_season(totals, season), ["season_year"], championship_order(), 10, rank_col="championship_position")
    top = season_slice(ranked)
    return lookup_with_default(top.select("season_year", "#", "Piloto", "Equipo", "Puntos", "Victorias", "Podios"),
                               "Equipo", colours, "team", "colour", DEFAULT_COLOUR)


# -- D3 / D4 / D5: points evolution page ------------------------------------------------------------
# Composite chunk: the round in the high bits, a block of the first tie-breaker in the low bits.
CHUNK_BLOCK_BITS, CHUNK_ROUND_SHIFT = 26, 40


def cumulative_points(stg_results: DataFrame, tiebreak=(), season=None, block_first_tiebreak: bool = False) -> DataFrame:
    """Running points per (season, driver) in round order, no position filter (unlike the marts).
    Rows of one round are ordered by ``tiebreak`` so the running value is deterministic.

    The running sum is chunked by round; with ``block_first_tiebreak`` (a non-negative integral first
    tie-breaker) a round is further cut into blocks of 2^26 values of that tie-breaker, so even one
    driver's round larger than a task is split, while the offsets window per driver stays at
    #rounds x #blocks rows."""
    df = _season(stg_results, season)
    chunk = F.col("round_number").cast("long")
    if block_first_tiebreak and tiebreak:
        chunk = chunk * F.lit(1 << CHUNK_ROUND_SHIFT) + F.shiftright(F.col(tiebreak[0]).cast("long"), CHUNK_BLOCK_BITS)
    names = ["season_year", "driver_name", "driver_code", "team_name", "round_number"]
    df = df.select(*names, *tiebreak, exact_points("points_scored").alias("_points"))
    out = running_sum(df, ["season_year", "driver_code"], ["round_number", *tiebreak], "_points", "cumulative_points", chunk=chunk)
    return out.select(*names, F.col("cumulative_points").cast("double").alias("cumulative_points"), *tiebreak)


def points_evolution(cumulative: DataFrame, stg_races: DataFrame) -> DataFrame:
    """Left join to the calendar on (season, round), null-safe like a pandas merge. A chart of one season draws
    it in round order."""
    r = stg_races.select(F.col("season_year").alias("_sy"), F.col("round_number").alias("_rn"), "event_name")
    cond = F.col("season_year").eqNullSafe(F.col("_sy")) & F.col("round_number").eqNullSafe(F.col("_rn"))
    return cumulative.join(r, cond, "left").drop("_sy", "_rn")


def axis_labels(stg_races: DataFrame, season=None) -> DataFrame:
    return _season(stg_races, season).select("season_year", "round_number",
                                             short_event_name("event_name").alias("tick_label"))


def default_driver_selection(cumulative: DataFrame, n: int = 2) -> DataFrame:
    """The first ``n`` driver names of each season in sorted order (the widget default)."""
    return first_n_distinct(cumulative, ["season_year"], "driver_name", n)


def compare_selected(evolution: DataFrame, selection: DataFrame) -> DataFrame:
    """Rows of the selected drivers: ``isin`` on a list becomes a semi join on (season, driver)."""
    return evolution.join(selection, ["season_year", "driver_name"], "left_semi")


def first_team_per_driver(cumulative: DataFrame, colours: DataFrame, tiebreak=()) -> DataFrame:
    """Team of each driver's first row (by round, then tie-breakers) and its colour."""
    first = first_value_by(cumulative, ["season_year", "driver_name"], "team_name", ["round_number", *tiebreak])
    return lookup_with_default(first, "team_name", colours, "team", "colour", DEFAULT_COLOUR)


def final_points(cumulative: DataFrame) -> DataFrame:
    """Highest running total per driver and its display text (``int`` truncation + ' pts')."""
    return (cumulative.groupBy("season_year", "driver_name")
            .agg(F.max("cumulative_points").alias("final_points"))
            .withColumn("final_label", points_label("final_points")))


# -- D6 / D7 / D8: fastest laps page -----------------------------------------------------------------
def season_laps(enriched: DataFrame, season=None) -> DataFrame:
    full = _season(enriched, season).select(
        "season_year",
        F.col("round_number").alias("Ronda"),
        F.col("event_name").alias("Carrera"),
        F.col("driver_code").alias("Piloto"),
        F.col("team_name").alias("Equipo"),
        F.col("lap_time_formatted").alias("Tiempo"),
        F.col("lap_time_seconds").alias("Segundos"),
        F.col("fastest_lap_rank_in_season").alias("Rank_Temporada"))
    return _in_order(full, season, asc("Ronda"))


def season_laps_table(enriched: DataFrame, season=None) -> DataFrame:
    """The displayed table: seconds dropped."""
    return season_laps(enriched, season).drop("Segundos")


def lap_axis_bounds(enriched: DataFrame, season=None) -> DataFrame:
    return (_season(enriched, season).groupBy("season_year")
            .agg((F.min("lap_time_seconds") * F.lit(0.995)).alias("y_min"),
                 (F.max("lap_time_seconds") * F.lit(1.005)).alias("y_max")))


def top5_laps(enriched: DataFrame, season=None) -> DataFrame:
    laps = season_laps(enriched, season)
    top = top_k_per_group(laps, ["season_year"], [asc("Rank_Temporada"), asc("Ronda")], 5)
    return top.select("season_year", "Rank_Temporada", "Piloto", "Equipo", "Carrera", "Tiempo")


# -- D9 / D10: teams page --------------------------------------------------------------------------
def team_history(performance: DataFrame) -> DataFrame:
    return performance.select(
        F.col("season_year").alias("Año"),
        F.col("team_name").alias("Equipo"),
        F.col("total_points").alias("Puntos"),
        F.col("wins").alias("Victorias"),
        F.col("podiums").alias("Podios"),
        F.col("total_entries").alias("Entradas"),
        round_half_away("avg_finish_position", 1).alias("Pos_Media")).orderBy(asc("Año"), desc("Puntos"))


def team_compare(history: DataFrame, colours: DataFrame, n_teams: int = 6) -> DataFrame:
    """Seasons of the first ``n_teams`` team names (sorted), with colours."""
    chosen = first_n_distinct(history, [], "Equipo", n_teams)
    picked = history.join(chosen, ["Equipo"], "left_semi").select("Año", "Equipo", "Puntos", "Victorias", "Podios")
    return lookup_with_default(picked, "Equipo", colours, "team", "colour", DEFAULT_COLOUR)


def team_colour_lookup(performance: DataFrame, colours: DataFrame) -> DataFrame:
    return lookup_with_default(performance.select("season_year", "team_name"), "team_name", colours, "team",
                               "colour", DEFAULT_COLOUR)


# -- H2-H6: the chatbot's example questions, for every season ------------------------------------------
def q_most_wins(totals: DataFrame) -> DataFrame:
    top = top_k_per_group(totals, ["season_year"], [desc("wins"), *championship_order()], 1)
    return top.select("season_year", "driver_name", "team_name", "wins")


def q_most_points_team(performance: DataFrame) -> DataFrame:
    return performance.where(F.col("constructors_position") == 1).select("season_year", "team_name", "total_points")


def q_fastest_lap_overall(stg_fastest_laps: DataFrame, stg_races: DataFrame) -> DataFrame:
    """The one lap first, then its calendar row and display columns."""
    one = top_k(stg_fastest_laps, [asc("lap_time_seconds"), asc("season_year"), asc("round_number")], 1)
    return fastest_laps_enriched(one, stg_races).select(
        "season_year", "round_number", "event_name", "driver_code", "team_name", "lap_time_formatted",
        "lap_time_seconds")


def q_driver_podiums(totals: DataFrame) -> DataFrame:
    return (totals.groupBy("season_year", "driver_code", "driver_name")
            .agg(F.sum("podiums").cast("bigint").alias("podiums")))


def q_most_finishes(totals: DataFrame) -> DataFrame:
    top = top_k_per_group(totals, ["season_year"], [desc("races_finished"), *championship_order()], 1)
    return top.select("season_year", "driver_name", "races_finished")
