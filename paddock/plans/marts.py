"""Marts (M1-M3): grouped aggregates plus a ranking window, and the lap table joined to the calendar.

Plan shape (``explain`` of ``driver_standings``): parquet scan with the not-null filter pushed down
-> partial HashAggregate (map-side combine, so a hot driver costs one row per task) -> exchange on
the 4 group keys -> final HashAggregate -> ranking. Ranking runs after aggregation, on one row per
driver and season (``driver_totals``, all that a top-k needs); because the drivers of one season still grow
with the data, the championship position is numbered per bucket of points (``distributed_row_number``)
instead of in one window task per season. Constructors and per-season laps are bounded by the
calendar and use plain windows. Points are summed as DECIMAL: a sum of doubles depends on its order.

Ties in points are broken by the group keys (ascending, nulls last) so ranks are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.ranking import distributed_row_number
from paddock.functions.columns import (
    FINISHED_STATUS,
    PODIUM_POSITION,
    POINTS_POSITION,
    WIN_POSITION,
    classify_position,
    exact_points,
    format_lap_time,
    round_half_away,
)


def _count_if(cond):
    return F.count(F.when(cond, F.lit(1)))


def _points():
    return F.sum(exact_points("points_scored")).cast("double")


DRIVER_KEYS = ["season_year", "driver_code", "driver_name", "team_name"]


def championship_order():
    """The championship's order within a season; total, because the keys are those of the rows."""
    return [F.col("total_points").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in DRIVER_KEYS[1:]]]


def driver_totals(stg_results: DataFrame) -> DataFrame:
    """The standings without the position."""
    pos = F.col("finish_position")
    return (stg_results.where(pos.isNotNull())
            .groupBy(*DRIVER_KEYS)
            .agg(F.count(F.lit(1)).alias("races_entered"),
                 _points().alias("total_points"),
                 _count_if(pos == WIN_POSITION).alias("wins"),
                 _count_if(pos <= PODIUM_POSITION).alias("podiums"),
                 _count_if(pos <= POINTS_POSITION).alias("points_finishes"),
                 _count_if(F.col("status") == FINISHED_STATUS).alias("races_finished"),
                 round_half_away(F.avg(pos), 2).alias("avg_finish_position"),
                 F.min(pos).alias("best_finish"),
                 classify_position(F.min(pos)).alias("best_finish_label")))


def driver_standings(stg_results: DataFrame) -> DataFrame:
    totals = driver_totals(stg_results)
    # buckets: equal points, and among those the head of the code
    rows = (totals.withColumn("_no_points", F.col("total_points").isNull())
            .withColumn("_points", F.coalesce("total_points", F.lit(0.0)))
            .withColumn("_no_code", F.col("driver_code").isNull())
            .withColumn("_head", F.coalesce(F.substring("driver_code", 1, 16), F.lit(""))))
    numbered = distributed_row_number(rows, ["season_year"], [("_no_points", False), ("_points", True), ("_no_code", False), ("_head", False)],
                                      championship_order(), "championship_position")
    return numbered.select(*totals.columns, "championship_position")


def team_performance(stg_results: DataFrame) -> DataFrame:
    """``count(distinct driver)`` beside plain aggregates: Spark plans it as two hash aggregates
    (by team+driver, then by team) with no Expand, because there is only one distinct column."""
    pos = F.col("finish_position")
    standings = (stg_results.where(pos.isNotNull())
                 .groupBy("season_year", "team_name")
                 .agg(F.count_distinct("driver_code").alias("drivers_count"),
                      F.count(F.lit(1)).alias("total_entries"),
                      _points().alias("total_points"),
                      _count_if(pos == WIN_POSITION).alias("wins"),
                      _count_if(pos <= PODIUM_POSITION).alias("podiums"),
                      round_half_away(F.avg(pos), 2).alias("avg_finish_position")))
    # teams per season are few (bounded by the constructors / nations), so one window task per season
    w = Window.partitionBy("season_year").orderBy(F.col("total_points").desc_nulls_last(),
                                                  F.col("team_name").asc_nulls_last())
    return standings.withColumn("constructors_position", F.row_number().over(w).cast("bigint"))


def fastest_laps_enriched(stg_fastest_laps: DataFrame, stg_races: DataFrame) -> DataFrame:
    """Left join of the per-race lap to the calendar on ``race_id`` (both sides hold one row per race,
    so AQE broadcasts whichever it measures small), then the in-season rank, nulls last."""
    f = stg_fastest_laps.alias("f")
    r = stg_races.select("race_id", "event_name", "country", "race_date").alias("r")
    w = Window.partitionBy("f.season_year").orderBy(F.col("f.lap_time_seconds").asc_nulls_last())
    return (f.join(r, F.col("f.race_id") == F.col("r.race_id"), "left")
            .select(format_lap_time(F.col("f.lap_time_seconds")).alias("lap_time_formatted"),
                    F.col("f.season_year").alias("season_year"),
                    F.col("f.round_number").alias("round_number"),
                    F.col("r.event_name").alias("event_name"),
                    F.col("r.country").alias("country"),
                    F.col("r.race_date").alias("race_date"),
                    F.col("f.driver_code").alias("driver_code"),
                    F.col("f.team_name").alias("team_name"),
                    F.col("f.lap_time_seconds").alias("lap_time_seconds"),
                    F.rank().over(w).cast("bigint").alias("fastest_lap_rank_in_season")))
