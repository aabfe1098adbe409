"""The model graph over a test-data directory: raw bindings -> staging -> marts.

A plain function per model replaces the template DAG of the original (``ref``/``source``). Each
returns a lazy DataFrame; composing them lets Catalyst inline and prune across layers (a mart that
never reads ``driver_number`` never scans ``l_suppkey`` for it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.plans import marts, staging
from paddock.sources import bindings as b


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.results_like(spark, sf_dir)


def raw_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.races_like(spark, sf_dir)


def raw_fastest_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fastest lap per race, picked from all lap rows of the race."""
    return staging.pick_fastest_lap(b.laps_like(spark, sf_dir), tiebreak=b.LAP_TIEBREAKS)


def stg_results(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return staging.stage_results(raw_results(spark, sf_dir), keep=keep)


def stg_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_races(raw_races(spark, sf_dir))


def stg_fastest_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_fastest_laps(raw_fastest_laps(spark, sf_dir))


def driver_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.driver_totals(stg_results(spark, sf_dir))


def driver_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.driver_standings(stg_results(spark, sf_dir))


def team_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.team_performance(stg_results(spark, sf_dir))


def fastest_laps_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fastest_laps_enriched(stg_fastest_laps(spark, sf_dir), stg_races(spark, sf_dir))
