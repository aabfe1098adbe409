"""Explicit schemas of every layer. Readers enforce them; nothing is inferred."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()

# Raw layer (landed files). ``date`` is ISO text as landed; staging casts it.
RAW_RACES = _s(("year", I), ("round", I), ("event_name", S), ("country", S), ("date", S))
RAW_RESULTS = _s(("year", I), ("round", I), ("event_name", S), ("driver_number", S), ("driver_code", S),
                 ("full_name", S), ("team", S), ("position", D), ("points", D), ("status", S))
RAW_FASTEST_LAPS = _s(("year", I), ("round", I), ("event_name", S), ("driver_code", S), ("team", S),
                      ("lap_time_seconds", D))
# CSV seeds carry the race date as a DATE.
SEED_RACES = _s(("year", I), ("round", I), ("event_name", S), ("country", S), ("date", DateType()))

# Staging layer.
STG_RACES = _s(("season_year", I), ("round_number", I), ("event_name", S), ("country", S),
               ("race_date", DateType()), ("race_id", S))
STG_RESULTS = _s(("result_sk", S), ("season_year", I), ("round_number", I), ("race_id", S),
                 ("driver_number", S), ("driver_code", S), ("driver_name", S), ("team_name", S),
                 ("finish_position", I), ("points_scored", D), ("status", S))
STG_FASTEST_LAPS = _s(("fastest_lap_sk", S), ("season_year", I), ("round_number", I), ("race_id", S),
                      ("event_name", S), ("driver_code", S), ("team_name", S), ("lap_time_seconds", D))

# Marts.
DRIVER_STANDINGS = _s(("season_year", I), ("driver_code", S), ("driver_name", S), ("team_name", S),
                      ("races_entered", L), ("total_points", D), ("wins", L), ("podiums", L),
                      ("points_finishes", L), ("races_finished", L), ("avg_finish_position", D),
                      ("best_finish", I), ("best_finish_label", S), ("championship_position", L))
TEAM_PERFORMANCE = _s(("season_year", I), ("team_name", S), ("drivers_count", L), ("total_entries", L),
                      ("total_points", D), ("wins", L), ("podiums", L), ("avg_finish_position", D),
                      ("constructors_position", L))
FASTEST_LAPS_ENRICHED = _s(("lap_time_formatted", S), ("season_year", I), ("round_number", I),
                           ("event_name", S), ("country", S), ("race_date", DateType()), ("driver_code", S),
                           ("team_name", S), ("lap_time_seconds", D), ("fastest_lap_rank_in_season", L))

# SCD2 validity columns appended to a snapshot's source columns.
SCD2_META = _s(("dbt_scd_id", S), ("dbt_updated_at", TimestampNTZType()), ("dbt_valid_from", TimestampNTZType()),
               ("dbt_valid_to", TimestampNTZType()))
