"""Staging models: rename and type the raw tables (P2-P4), pick the fastest lap of a race (A15),
and coerce landed API rows to the raw schema (J7, X17, X18, P10).

Each function is a pure DataFrame -> DataFrame projection; ``keep`` carries extra lineage columns
(tie-breakers) through for deterministic downstream windows without changing the model's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.columns import (
    interval_seconds,
    nan_to_null,
    race_id,
    round_half_away,
    surrogate_key,
    text_or_empty,
    to_int,
)
from paddock.operators.ranking import top_k_per_group


def stage_races(raw: DataFrame, keep=()) -> DataFrame:
    return raw.select(
        F.col("year").alias("season_year"),
        F.col("round").alias("round_number"),
        "event_name",
        "country",
        F.col("date").cast("date").alias("race_date"),
        race_id("year", "round").alias("race_id"),
        *keep)


def stage_results(raw: DataFrame, keep=()) -> DataFrame:
    return raw.select(
        surrogate_key("year", "round", "driver_code").alias("result_sk"),
        F.col("year").alias("season_year"),
        F.col("round").alias("round_number"),
        race_id("year", "round").alias("race_id"),
        "driver_number",
        "driver_code",
        F.col("full_name").alias("driver_name"),
        F.col("team").alias("team_name"),
        to_int("position").alias("finish_position"),
        F.col("points").cast("double").alias("points_scored"),
        "status",
        *keep)


def stage_fastest_laps(raw: DataFrame, keep=()) -> DataFrame:
    return raw.select(
        surrogate_key("year", "round", "driver_code").alias("fastest_lap_sk"),
        F.col("year").alias("season_year"),
        F.col("round").alias("round_number"),
        race_id("year", "round").alias("race_id"),
        "event_name",
        "driver_code",
        F.col("team").alias("team_name"),
        round_half_away("lap_time_seconds", 3).alias("lap_time_seconds"),
        *keep)


def pick_fastest_lap(laps: DataFrame, race_cols=("year", "round"), time_col="lap_time_seconds",
                     tiebreak=(), payload=("event_name", "driver_code", "team")) -> DataFrame:
    """Fastest lap per race: the first by time, then by the tie-breakers, in one pass over the laps.

    Every task forwards its best lap of each race only (``WindowGroupLimit`` below the exchange), so a race that
    holds a third of all laps sends one row per task, and what follows sees one row per race and task. Laps without a
    time are ignored (a race of untimed laps yields no row).
    """
    rows = laps.where(F.col(time_col).isNotNull()).select(*race_cols, *payload, time_col, *tiebreak)
    return top_k_per_group(rows, race_cols, [time_col, *tiebreak], 1).select(*race_cols, *payload, time_col)


def exclude_testing_events(landed: DataFrame, round_col: str = "round") -> DataFrame:
    """Drop pre-season testing events from a landed table: they carry round 0 (F9). A missing round is
    not round 0 and stays, to be found by the landing check."""
    return landed.where(~F.col(round_col).eqNullSafe(F.lit(0)))


def coerce_laps(landed: DataFrame) -> DataFrame:
    """Landed laps -> raw_fastest_laps: a lap time that landed as an interval (``lap_time``) becomes seconds."""
    if "lap_time" not in landed.columns:
        return landed
    return landed.withColumn("lap_time_seconds", interval_seconds("lap_time")).drop("lap_time")


def coerce_results(landed: DataFrame, calendar: DataFrame, year_col="year", round_col="round",
                   season: int | None = None) -> DataFrame:
    """Landed session rows -> raw_results: calendar fields copied by an inner join on (year, round),
    missing text fields -> '', text coercion of codes and names, NaN numbers -> null. With ``season``
    the rows carry no year of their own and the season is stamped on every row (P10)."""
    if season is not None:
        landed = landed.withColumn("year", F.lit(season).cast("int"))
    cal = calendar.select(F.col(year_col).alias("year"), F.col(round_col).alias("round"), "event_name")
    return (landed.drop("event_name").join(cal, ["year", "round"])
            .select("year", "round", "event_name",
                    text_or_empty("driver_number").alias("driver_number"),
                    text_or_empty("driver_code").alias("driver_code"),
                    text_or_empty("full_name").alias("full_name"),
                    text_or_empty("team").alias("team"),
                    nan_to_null(F.col("position").cast("double")).alias("position"),
                    nan_to_null(F.col("points").cast("double")).alias("points"),
                    text_or_empty("status").alias("status")))
