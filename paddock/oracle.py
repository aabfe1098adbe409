"""Independent SQL oracles (DuckDB dialect) for every registered query.

The same bindings as ``paddock.sources.bindings`` are written here a second time, as SQL, so the
check compares two separate formulations. The tables ``lineitem orders supplier nation customer
events`` are views over the parquet files. Each oracle states the rule it pins with plain SQL:
``round`` keeps DuckDB's own rounding, ``CAST(double AS INTEGER)`` its half-even cast, ``NOT IN``
its null-aware semantics.
"""

from __future__ import annotations

SK_NULL = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), {SK_NULL})" for c in cols)
    return f"md5({parts})"


def rid(y: str = "year", r: str = "round") -> str:
    return f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({r} AS VARCHAR), 2, '0'))"


ROUND_OF = "(CAST(floor((dayofyear({c}) - 1) / 7) AS INTEGER) + 1)"

RESULTS_LIKE = f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
       {ROUND_OF.format(c='o.o_orderdate')} AS round,
       'Round ' || CAST({ROUND_OF.format(c='o.o_orderdate')} AS VARCHAR) AS event_name,
       CAST(l.l_suppkey AS VARCHAR) AS driver_number,
       s.s_name AS driver_code,
       'Driver ' || s.s_name AS full_name,
       n.n_name AS team,
       CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(ceil(l.l_quantity / 2.5) AS DOUBLE) END AS position,
       51.0 - l.l_quantity AS points,
       CASE WHEN l.l_linestatus = 'F' THEN 'Finished' ELSE 'Retired' END AS status,
       l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice, o.o_orderdate
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""

LAPS_LIKE = f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
       {ROUND_OF.format(c='o.o_orderdate')} AS round,
       'Round ' || CAST({ROUND_OF.format(c='o.o_orderdate')} AS VARCHAR) AS event_name,
       s.s_name AS driver_code,
       n.n_name AS team,
       l.l_extendedprice / 1000.0 AS lap_time_seconds,
       l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, o.o_orderdate
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""


def races_like(orders_rel: str = "orders") -> str:
    return f"""
SELECT year, round, 'Round ' || CAST(round AS VARCHAR) AS event_name, country, date FROM (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
         {ROUND_OF.format(c='o.o_orderdate')} AS round,
         arg_min(n.n_name, n.n_nationkey) AS country,
         CAST(min(o.o_orderdate) AS DATE) AS date
  FROM {orders_rel} o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2) t"""


RACES_LIKE = races_like()

FASTEST_RAW = f"""
SELECT year, round, event_name, driver_code, team, lap_time_seconds FROM (
  SELECT *, row_number() OVER (PARTITION BY year, round
           ORDER BY lap_time_seconds, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
  FROM laps_like WHERE lap_time_seconds IS NOT NULL) t
WHERE rn = 1"""


def stg_results_sql(src: str = "raw_results", extra: str = "") -> str:
    return f"""
SELECT {sk('year', 'round', 'driver_code')} AS result_sk,
       year AS season_year, round AS round_number, {rid()} AS race_id,
       driver_number, driver_code, full_name AS driver_name, team AS team_name,
       CAST(position AS INTEGER) AS finish_position, CAST(points AS DOUBLE) AS points_scored, status{extra}
FROM {src}"""


STG_RACES = f"""
SELECT year AS season_year, round AS round_number, event_name, country,
       CAST(date AS DATE) AS race_date, {rid()} AS race_id
FROM raw_races"""

STG_LAPS = f"""
SELECT {sk('year', 'round', 'driver_code')} AS fastest_lap_sk,
       year AS season_year, round AS round_number, {rid()} AS race_id,
       event_name, driver_code, team AS team_name, round(lap_time_seconds, 3) AS lap_time_seconds
FROM raw_fastest_laps"""

# Fixed values in the CASE: the labels of finishing positions.
DRIVER_STANDINGS = """
SELECT *, row_number() OVER (PARTITION BY season_year
          ORDER BY total_points DESC, driver_code, driver_name, team_name) AS championship_position
FROM (
  SELECT season_year, driver_code, driver_name, team_name,
         count(*) AS races_entered,
         sum(points_scored) AS total_points,
         count(CASE WHEN finish_position = 1 THEN 1 END) AS wins,
         count(CASE WHEN finish_position <= 3 THEN 1 END) AS podiums,
         count(CASE WHEN finish_position <= 10 THEN 1 END) AS points_finishes,
         count(CASE WHEN status = 'Finished' THEN 1 END) AS races_finished,
         round(avg(finish_position), 2) AS avg_finish_position,
         min(finish_position) AS best_finish,
         CASE WHEN min(finish_position) = 1 THEN 'Victoria'
              WHEN min(finish_position) <= 3 THEN 'Podio'
              WHEN min(finish_position) <= 10 THEN 'Puntos'
              WHEN min(finish_position) IS NOT NULL THEN 'Sin puntos'
              ELSE 'No clasificado' END AS best_finish_label
  FROM stg_results
  WHERE finish_position IS NOT NULL
  GROUP BY season_year, driver_code, driver_name, team_name) s"""

TEAM_PERFORMANCE = """
SELECT *, row_number() OVER (PARTITION BY season_year ORDER BY total_points DESC, team_name) AS constructors_position
FROM (
  SELECT season_year, team_name,
         count(DISTINCT driver_code) AS drivers_count,
         count(*) AS total_entries,
         sum(points_scored) AS total_points,
         count(CASE WHEN finish_position = 1 THEN 1 END) AS wins,
         count(CASE WHEN finish_position <= 3 THEN 1 END) AS podiums,
         round(avg(finish_position), 2) AS avg_finish_position
  FROM stg_results
  WHERE finish_position IS NOT NULL
  GROUP BY season_year, team_name) p"""

FASTEST_ENRICHED = """
SELECT CAST(CAST(floor(f.lap_time_seconds / 60) AS INTEGER) AS VARCHAR) || ':' || printf('%06.3f', f.lap_time_seconds % 60)
         AS lap_time_formatted,
       f.season_year, f.round_number, r.event_name, r.country, r.race_date, f.driver_code, f.team_name,
       f.lap_time_seconds,
       rank() OVER (PARTITION BY f.season_year ORDER BY f.lap_time_seconds ASC) AS fastest_lap_rank_in_season
FROM stg_fastest_laps f LEFT JOIN stg_races r ON f.race_id = r.race_id"""


def with_(body: str, **ctes: str) -> str:
    """``WITH name AS (...), ... body`` in the given order."""
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


# Common stacks of bindings.
RESULTS_STACK = dict(raw_results=RESULTS_LIKE, stg_results=stg_results_sql())
RACES_STACK = dict(raw_races=RACES_LIKE, stg_races=STG_RACES)
LAPS_STACK = dict(laps_like=LAPS_LIKE, raw_fastest_laps=FASTEST_RAW, stg_fastest_laps=STG_LAPS)
ENRICHED_STACK = dict(**LAPS_STACK, **RACES_STACK, fastest_laps_enriched=FASTEST_ENRICHED)
STANDINGS_STACK = dict(**RESULTS_STACK, driver_standings=DRIVER_STANDINGS)
TEAMS_STACK = dict(**RESULTS_STACK, team_performance=TEAM_PERFORMANCE)

ORACLES: dict[str, str] = {
    "driver_standings": with_("SELECT * FROM driver_standings", **STANDINGS_STACK),
    "team_performance": with_("SELECT * FROM team_performance", **TEAMS_STACK),
    "fastest_laps_enriched": with_("SELECT * FROM fastest_laps_enriched", **ENRICHED_STACK),
    "stage_results": with_("SELECT * FROM stg_results", **RESULTS_STACK),
    "stage_races": with_("SELECT * FROM stg_races", **RACES_STACK),
    "stage_fastest_laps": with_("SELECT * FROM stg_fastest_laps", **LAPS_STACK),
    "pick_fastest_lap": with_("SELECT * FROM raw_fastest_laps", **LAPS_STACK),
}

# --- scalar functions ----------------------------------------------------------------------------
# The colour table of the dashboard, in its natural order.
COLOURS_SQL = """
SELECT n.n_name AS team, v.colour FROM nation n JOIN (VALUES
  (0, '#3671C6'), (1, '#E8002D'), (2, '#27F4D2'), (3, '#FF87BC'), (4, '#FF8000'), (5, '#C92D4B'),
  (6, '#229971'), (7, '#B6BABD'), (8, '#6692FF'), (9, '#64C4FF'), (10, '#229971'), (11, '#C92D4B'),
  (12, '#6692FF'), (13, '#6692FF'), (14, '#FF87BC'), (15, '#B6BABD')) v(idx, colour)
ON n.n_nationkey = v.idx"""

LAP_FMT = ("CAST(CAST(floor({s} / 60) AS INTEGER) AS VARCHAR) || ':' || printf('%06.3f', {s} % 60)")

ORACLES.update({
    "race_key": with_(f"SELECT year, round, {rid()} AS race_id FROM raw_races", raw_races=RACES_LIKE),
    "cast_position": """
SELECT l_orderkey, l_linenumber, l_quantity / 4.0 AS position_raw,
       CAST(l_quantity / 4.0 AS INTEGER) AS finish_position
FROM lineitem""",
    "format_lap_time": with_(
        f"SELECT l_orderkey, l_linenumber, round(lap_time_seconds, 3) AS lap_time_seconds, "
        f"{LAP_FMT.format(s='round(lap_time_seconds, 3)')} AS lap_time_formatted FROM laps_like",
        laps_like=LAPS_LIKE),
    # fixed values: the labels of finishing positions
    "classify_position": with_("""
SELECT l_orderkey, l_linenumber, finish_position,
       CASE WHEN finish_position = 1 THEN 'Victoria'
            WHEN finish_position <= 3 THEN 'Podio'
            WHEN finish_position <= 10 THEN 'Puntos'
            WHEN finish_position IS NOT NULL THEN 'Sin puntos'
            ELSE 'No clasificado' END AS position_label
FROM stg_results""", raw_results=RESULTS_LIKE, stg_results=stg_results_sql(extra=", l_orderkey, l_linenumber")),
    "surrogate_key": with_(f"SELECT year, round, driver_code, {sk('year', 'round', 'driver_code')} AS result_sk "
                           f"FROM raw_results", raw_results=RESULTS_LIKE),
    "coerce_results": with_("""
SELECT l.year, l.round, c.event_name,
       coalesce(CAST(l.driver_number AS VARCHAR), '') AS driver_number,
       coalesce(CAST(l.driver_code AS VARCHAR), '') AS driver_code,
       coalesce(CAST(l.full_name AS VARCHAR), '') AS full_name,
       coalesce(CAST(l.team AS VARCHAR), '') AS team,
       CASE WHEN isnan(l.position) THEN NULL ELSE l.position END AS position,
       CASE WHEN isnan(l.points) THEN NULL ELSE l.points END AS points,
       coalesce(CAST(l.status AS VARCHAR), '') AS status
FROM landed l JOIN raw_races c ON l.year = c.year AND l.round = c.round""",
        raw_races=RACES_LIKE,
        landed=f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, {ROUND_OF.format(c='o.o_orderdate')} AS round,
       l.l_suppkey AS driver_number, s.s_name AS driver_code, 'Driver ' || s.s_name AS full_name,
       n.n_name AS team,
       CASE WHEN l.l_returnflag = 'R' THEN CAST('NaN' AS DOUBLE) ELSE CAST(ceil(l.l_quantity / 2.5) AS DOUBLE) END
         AS position,
       51.0 - l.l_quantity AS points,
       CASE WHEN l.l_linestatus = 'F' THEN 'Finished' ELSE 'Retired' END AS status
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
})

# --- dashboard -----------------------------------------------------------------------------------
SEASON_SLICE = """
SELECT season_year, championship_position AS "#", driver_name AS Piloto, team_name AS Equipo,
       total_points AS Puntos, wins AS Victorias, podiums AS Podios, races_entered AS Carreras,
       round(avg_finish_position, 1) AS Pos_Media
FROM driver_standings"""

TIEBREAK_COLS = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice"
CUMULATIVE = f"""
SELECT season_year, driver_name, driver_code, team_name, round_number,
       sum(points_scored) OVER (PARTITION BY season_year, driver_code
                                ORDER BY round_number, {TIEBREAK_COLS}
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_points,
       {TIEBREAK_COLS}
FROM stg_results"""
CUM_STACK = dict(raw_results=RESULTS_LIKE, stg_results=stg_results_sql(extra=", " + TIEBREAK_COLS),
                 cum=CUMULATIVE)
EVOLUTION = """
SELECT c.*, r.event_name FROM cum c LEFT JOIN stg_races r
  ON c.season_year IS NOT DISTINCT FROM r.season_year AND c.round_number IS NOT DISTINCT FROM r.round_number"""
SELECTION = """
SELECT season_year, driver_name FROM (
  SELECT season_year, driver_name, row_number() OVER (PARTITION BY season_year ORDER BY driver_name) AS rn
  FROM (SELECT DISTINCT season_year, driver_name FROM cum) d) t
WHERE rn <= 2"""
TEAM_HISTORY = """
SELECT season_year AS "Año", team_name AS Equipo, total_points AS Puntos, wins AS Victorias,
       podiums AS Podios, total_entries AS Entradas, round(avg_finish_position, 1) AS Pos_Media
FROM team_performance
ORDER BY season_year, Puntos DESC"""
SEASON_LAPS = """
SELECT season_year, round_number AS Ronda, event_name AS Carrera, driver_code AS Piloto, team_name AS Equipo,
       lap_time_formatted AS Tiempo, fastest_lap_rank_in_season AS Rank_Temporada
FROM fastest_laps_enriched"""

ORACLES.update({
    "season_slice": with_(SEASON_SLICE, **STANDINGS_STACK),
    "top10_drivers": with_("""
SELECT s.season_year, s."#", s.Piloto, s.Equipo, s.Puntos, s.Victorias, s.Podios,
       coalesce(c.colour, '#e10600') AS colour
FROM season_slice s LEFT JOIN colours c ON s.Equipo = c.team
WHERE s."#" <= 10""", **STANDINGS_STACK, season_slice=SEASON_SLICE, colours=COLOURS_SQL),
    "cumulative_points": with_("SELECT * FROM cum", **CUM_STACK),
    "cumulative_points_events": """
SELECT user_id, ts, event_id, value,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_value
FROM events""",
    "points_evolution": with_(EVOLUTION, **CUM_STACK, **RACES_STACK),
    "axis_labels": with_("SELECT season_year, round_number, replace(event_name, ' Grand Prix', ' GP') AS tick_label "
                         "FROM stg_races", **RACES_STACK),
    "compare_selected": with_("""
SELECT e.* FROM evolution e
WHERE EXISTS (SELECT 1 FROM selection s WHERE s.season_year = e.season_year AND s.driver_name = e.driver_name)""",
                              **CUM_STACK, **RACES_STACK, evolution=EVOLUTION, selection=SELECTION),
    "first_team_per_driver": with_(f"""
SELECT f.season_year, f.driver_name, f.team_name, coalesce(c.colour, '#e10600') AS colour FROM (
  SELECT season_year, driver_name, team_name,
         row_number() OVER (PARTITION BY season_year, driver_name ORDER BY round_number, {TIEBREAK_COLS}) AS rn
  FROM cum) f
LEFT JOIN colours c ON f.team_name = c.team
WHERE f.rn = 1""", **CUM_STACK, colours=COLOURS_SQL),
    "final_points": with_("""
SELECT season_year, driver_name, max(cumulative_points) AS final_points,
       CAST(CAST(trunc(max(cumulative_points)) AS INTEGER) AS VARCHAR) || ' pts' AS final_label
FROM cum GROUP BY season_year, driver_name""", **CUM_STACK),
    "distinct_sorted": with_("""
SELECT *, row_number() OVER (PARTITION BY season_year ORDER BY driver_name NULLS LAST) AS place
FROM (SELECT DISTINCT season_year, driver_name FROM stg_results) d""", **RESULTS_STACK),
    "seasons_descending": with_("""
SELECT *, row_number() OVER (ORDER BY season_year DESC NULLS LAST) AS place
FROM (SELECT DISTINCT season_year FROM stg_races) d""", **RACES_STACK),
    "season_slice_bound": with_(SEASON_SLICE + "\nWHERE season_year = 1996\nORDER BY championship_position", **STANDINGS_STACK),
    "cumulative_points_sparse": with_(f"""
SELECT season_year, driver_name, driver_code, team_name, round_number,
       CAST(sum(CAST(points_scored AS DECIMAL(18,6))) OVER (PARTITION BY season_year, driver_code
                                ORDER BY round_number NULLS LAST, {TIEBREAK_COLS}
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_points,
       {TIEBREAK_COLS}
FROM stg_results""", raw_all=RESULTS_LIKE,
                                      raw_results="""
SELECT * REPLACE (CASE WHEN l_linenumber <> 1 THEN round END AS round, l_quantity / CAST(10.0 AS DOUBLE) AS points) FROM raw_all""",
                                      stg_results=stg_results_sql(extra=", " + TIEBREAK_COLS)),
    "season_laps": with_(SEASON_LAPS, **ENRICHED_STACK),
    "lap_axis_bounds": with_("""
SELECT season_year, min(lap_time_seconds) * CAST(0.995 AS DOUBLE) AS y_min,
       max(lap_time_seconds) * CAST(1.005 AS DOUBLE) AS y_max
FROM fastest_laps_enriched GROUP BY season_year""", **ENRICHED_STACK),
    "top5_laps": with_("""
SELECT season_year, Rank_Temporada, Piloto, Equipo, Carrera, Tiempo FROM (
  SELECT *, row_number() OVER (PARTITION BY season_year ORDER BY Rank_Temporada, Ronda) AS rn
  FROM season_laps) t
WHERE rn <= 5""", **ENRICHED_STACK, season_laps=SEASON_LAPS),
    "team_history": with_(TEAM_HISTORY, **TEAMS_STACK),
    "team_compare": with_("""
SELECT h."Año", h.Equipo, h.Puntos, h.Victorias, h.Podios, coalesce(c.colour, '#e10600') AS colour
FROM history h LEFT JOIN colours c ON h.Equipo = c.team
WHERE h.Equipo IN (SELECT DISTINCT Equipo FROM history ORDER BY Equipo LIMIT 6)""",
                          **TEAMS_STACK, history=TEAM_HISTORY, colours=COLOURS_SQL),
    "team_colour_lookup": with_("""
SELECT p.season_year, p.team_name, coalesce(c.colour, '#e10600') AS colour
FROM team_performance p LEFT JOIN colours c ON p.team_name = c.team""", **TEAMS_STACK, colours=COLOURS_SQL),
    "distinct_driver_teams": with_(f"""
SELECT {sk('driver_code', 'season_year')} AS driver_team_sk, driver_code, driver_name, season_year, team_name
FROM stg_results GROUP BY driver_code, driver_name, team_name, season_year""", **RESULTS_STACK),
    "load_summary": with_("""
SELECT 'raw_races' AS table_name, count(*) AS row_count FROM raw_races
UNION ALL SELECT 'raw_results', count(*) FROM raw_results
UNION ALL SELECT 'raw_fastest_laps', count(*) FROM raw_fastest_laps""",
                          raw_races=RACES_LIKE, raw_results=RESULTS_LIKE, **LAPS_STACK),
})

# --- questions -----------------------------------------------------------------------------------
ADHOC_EXAMPLE = ("SELECT season_year, driver_name, team_name, wins FROM driver_standings "
                 "WHERE championship_position <= 3")

ORACLES.update({
    "q_most_wins": with_("""
SELECT season_year, driver_name, team_name, wins FROM (
  SELECT *, row_number() OVER (PARTITION BY season_year ORDER BY wins DESC, championship_position) AS rn
  FROM driver_standings) t WHERE rn = 1""", **STANDINGS_STACK),
    "q_most_points_team": with_("SELECT season_year, team_name, total_points FROM team_performance "
                                "WHERE constructors_position = 1", **TEAMS_STACK),
    "q_fastest_lap_overall": with_("""
SELECT season_year, round_number, event_name, driver_code, team_name, lap_time_formatted, lap_time_seconds
FROM fastest_laps_enriched ORDER BY lap_time_seconds, season_year, round_number LIMIT 1""", **ENRICHED_STACK),
    "q_driver_podiums": with_("""
SELECT season_year, driver_code, driver_name, CAST(sum(podiums) AS BIGINT) AS podiums
FROM driver_standings GROUP BY season_year, driver_code, driver_name""", **STANDINGS_STACK),
    "q_most_finishes": with_("""
SELECT season_year, driver_name, races_finished FROM (
  SELECT *, row_number() OVER (PARTITION BY season_year ORDER BY races_finished DESC, championship_position) AS rn
  FROM driver_standings) t WHERE rn = 1""", **STANDINGS_STACK),
    "adhoc_sql": with_(f"SELECT * FROM ({ADHOC_EXAMPLE}) q", **STANDINGS_STACK),
})

# --- expectations --------------------------------------------------------------------------------
MARTS_STACK = dict(**STANDINGS_STACK, team_performance=TEAM_PERFORMANCE, **{
    k: v for k, v in ENRICHED_STACK.items()})


def _nn(table: str, col: str) -> str:
    return (f"SELECT 'not_null' AS test_name, '{table}' AS table_name, '{col}' AS column_name, "
            f"count(*) FILTER (WHERE {col} IS NULL) AS violations FROM {table}")


NOT_NULL_UNION = "\nUNION ALL ".join(_nn(t, c) for t, c in (
    ("driver_standings", "driver_code"), ("driver_standings", "season_year"),
    ("driver_standings", "total_points"), ("driver_standings", "championship_position"),
    ("team_performance", "team_name"), ("team_performance", "season_year"),
    ("team_performance", "total_points"),
    ("fastest_laps_enriched", "driver_code"), ("fastest_laps_enriched", "lap_time_seconds")))
RELATIONSHIP = """
SELECT r.team_name AS from_field FROM stg_results r LEFT JOIN colours c ON r.team_name = c.team
WHERE r.team_name IS NOT NULL AND c.team IS NULL"""

ORACLES.update({
    "expect_not_null": with_(NOT_NULL_UNION, **MARTS_STACK),
    "expect_unique_combination": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "expect_relationship": with_(RELATIONSHIP, **RESULTS_STACK, colours=COLOURS_SQL),
    "expectation_report": with_(NOT_NULL_UNION + """
UNION ALL SELECT 'unique_combination', 'driver_standings', 'season_year,championship_position', count(*) FROM (
  SELECT season_year, championship_position FROM driver_standings
  GROUP BY season_year, championship_position HAVING count(*) > 1) u
UNION ALL SELECT 'relationships', 'stg_results', 'team_name', count(*) FROM (""" + RELATIONSHIP + ") rel",
                                **MARTS_STACK, colours=COLOURS_SQL),
})

# --- table maintenance: closed forms of the stepwise runs ------------------------------------------
CUT1, CUT2 = "TIMESTAMP '1998-06-17 00:00:00'", "TIMESTAMP '2000-03-09 00:00:00'"
BATCH_OF = f"(CASE WHEN o_orderdate < {CUT1} THEN 1 WHEN o_orderdate < {CUT2} THEN 2 ELSE 3 END)"
RAW_COLS = "year, round, event_name, driver_number, driver_code, full_name, team, position, points, status"
ORDERS_B1 = f"SELECT * FROM orders WHERE o_orderdate < {CUT1}"
ORDERS_B2 = f"SELECT * FROM orders WHERE o_orderdate < {CUT2}"
FIRST_BATCH = """
SELECT * FROM (
  SELECT *, min(b) OVER (PARTITION BY {part}) AS first_b FROM (
    SELECT *, {batch} AS b FROM raw_results) x) y
WHERE b = first_b"""


def _stg_races_of(rel: str) -> str:
    return STG_RACES.replace("FROM raw_races", f"FROM {rel}")


def _laps_of(batch_pred: str) -> str:
    return FASTEST_RAW.replace("FROM laps_like WHERE", f"FROM laps_like WHERE {batch_pred} AND")


ORACLES.update({
    "schema_clone": with_(f"SELECT {RAW_COLS} FROM raw_results WHERE 1 = 0", raw_results=RESULTS_LIKE),
    # every season ends with the calendar of its last batch, and the last batch of a season holds all of it
    "replace_season": with_("SELECT * FROM raw_races", raw_races=RACES_LIKE),
    "ingest_results": with_("""
SELECT l.year, l.round, c.event_name, coalesce(driver_number, '') AS driver_number, coalesce(driver_code, '') AS driver_code,
       full_name, team, position, points, coalesce(status, '') AS status
FROM landed l JOIN raw_races c ON l.year = c.year AND l.round = c.round""", raw_races=RACES_LIKE, landed=f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, {ROUND_OF.format(c='o.o_orderdate')} AS round,
       CASE WHEN l.l_suppkey % 5 <> 0 THEN CAST(l.l_suppkey AS VARCHAR) END AS driver_number,
       CASE WHEN l.l_suppkey % 3 <> 0 THEN s.s_name END AS driver_code, 'Driver ' || s.s_name AS full_name, n.n_name AS team,
       CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(ceil(l.l_quantity / 2.5) AS DOUBLE) END AS position,
       CASE WHEN l.l_returnflag = 'A' THEN NULL ELSE 51.0 - l.l_quantity END AS points,
       CASE WHEN l.l_linestatus = 'F' THEN 'Finished' END AS status
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE l.l_linenumber <> 7"""),
    "csv_round_trip": with_(f"SELECT {RAW_COLS} FROM raw_results", raw_results=RESULTS_LIKE),
    "incremental_not_in": with_(f"""
SELECT * FROM (SELECT {RAW_COLS}, {rid()} AS race_id FROM raw_results) x
WHERE race_id NOT IN (SELECT race_id FROM stg_b1)""",
                                raw_results=RESULTS_LIKE, raw_b1=f"SELECT * FROM raw_results WHERE {BATCH_OF} = 1",
                                stg_b1=stg_results_sql("raw_b1")),
    "append_new_rounds": with_(f"SELECT {RAW_COLS} FROM kept", raw_results=RESULTS_LIKE,
                               kept=FIRST_BATCH.format(part="year, round", batch=BATCH_OF)),
    "incremental_results": with_("SELECT * FROM stg", raw_results=RESULTS_LIKE,
                                 kept=FIRST_BATCH.format(part=rid(), batch=BATCH_OF),
                                 stg=stg_results_sql("kept")),
    "incremental_races": with_("""
SELECT * FROM s1
UNION ALL SELECT * FROM s2 WHERE race_id NOT IN (SELECT race_id FROM s1)
UNION ALL SELECT * FROM s3 WHERE race_id NOT IN (SELECT race_id FROM s1 UNION ALL SELECT race_id FROM s2)""",
                               o1=ORDERS_B1, o2=ORDERS_B2, r1=races_like("o1"), r2=races_like("o2"),
                               r3=races_like("orders"), s1=_stg_races_of("r1"), s2=_stg_races_of("r2"),
                               s3=_stg_races_of("r3")),
    "incremental_laps": with_("""
SELECT * FROM s1
UNION ALL SELECT * FROM s2 WHERE race_id NOT IN (SELECT race_id FROM s1)
UNION ALL SELECT * FROM s3 WHERE race_id NOT IN (SELECT race_id FROM s1 UNION ALL SELECT race_id FROM s2)""",
                              laps_like=LAPS_LIKE,
                              fl1=_laps_of(f"{BATCH_OF} <= 1"), fl2=_laps_of(f"{BATCH_OF} <= 2"),
                              fl3=_laps_of(f"{BATCH_OF} <= 3"),
                              s1=STG_LAPS.replace("FROM raw_fastest_laps", "FROM fl1"),
                              s2=STG_LAPS.replace("FROM raw_fastest_laps", "FROM fl2"),
                              s3=STG_LAPS.replace("FROM raw_fastest_laps", "FROM fl3")),
    "upsert_by_key": with_("""
SELECT * FROM t2 WHERE result_sk NOT IN (SELECT result_sk FROM s3)
UNION ALL SELECT * FROM s3""",
                           raw_results=RESULTS_LIKE,
                           b1=f"SELECT * FROM raw_results WHERE {BATCH_OF} = 1",
                           b2=f"SELECT * FROM raw_results WHERE {BATCH_OF} = 2",
                           b3=f"SELECT * FROM raw_results WHERE {BATCH_OF} = 3",
                           s1=stg_results_sql("b1"), s2=stg_results_sql("b2"), s3=stg_results_sql("b3"),
                           t2="SELECT * FROM s1 WHERE result_sk NOT IN (SELECT result_sk FROM s2) "
                              "UNION ALL SELECT * FROM s2"),
})

SNAPSHOT_VERSIONS = f"""
WITH src AS (
  SELECT snapshot_year, o_custkey, o_orderpriority FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS snapshot_year, o_custkey, o_orderpriority,
           row_number() OVER (PARTITION BY year(o_orderdate), o_custkey
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) t WHERE rn = 1),
runs AS (
  SELECT *, {sk('o_custkey')} AS snapshot_sk, make_timestamp(snapshot_year + 1, 1, 1, 0, 0, 0) AS ts FROM src),
flagged AS (
  SELECT *, row_number() OVER w AS rn, lag(o_orderpriority) OVER w AS prev
  FROM runs WINDOW w AS (PARTITION BY snapshot_sk ORDER BY snapshot_year)),
starts AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority),
versions AS (
  SELECT snapshot_sk, o_custkey, o_orderpriority,
         md5(snapshot_sk || '|' || CAST(ts AS VARCHAR)) AS dbt_scd_id,
         ts AS dbt_updated_at, ts AS dbt_valid_from,
         lead(ts) OVER (PARTITION BY snapshot_sk ORDER BY ts) AS dbt_valid_to
  FROM starts)
"""

DRIVER_TEAM_VERSIONS = f"""
WITH rows AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS season_year, {ROUND_OF.format(c='o_orderdate')} AS round, 'D' || l_suppkey AS driver_code,
         n_name AS team_name, l_orderkey, l_linenumber, {BATCH_OF} AS batch
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
run AS (SELECT * FROM (VALUES (1, {CUT1}), (2, {CUT2}), (3, TIMESTAMP '2002-01-01 00:00:00')) v(run, ts)),
latest AS (
  SELECT run, ts, season_year, driver_code, team_name FROM (
    SELECT *, row_number() OVER (PARTITION BY run, season_year, driver_code ORDER BY round DESC, l_orderkey DESC, l_linenumber DESC) AS rn
    FROM rows JOIN run ON batch <= run) t WHERE rn = 1),
flagged AS (
  SELECT *, {sk('driver_code', 'season_year')} AS driver_team_sk, row_number() OVER w AS rn, lag(team_name) OVER w AS prev
  FROM latest WINDOW w AS (PARTITION BY season_year, driver_code ORDER BY run)),
starts AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM team_name)
SELECT driver_code, season_year, team_name, driver_team_sk, md5(driver_team_sk || '|' || CAST(ts AS VARCHAR)) AS dbt_scd_id,
       ts AS dbt_updated_at, ts AS dbt_valid_from, lead(ts) OVER (PARTITION BY driver_team_sk ORDER BY ts) AS dbt_valid_to
FROM starts"""

ORACLES.update({
    "scd2_driver_team": DRIVER_TEAM_VERSIONS,
    "scd2_history": SNAPSHOT_VERSIONS + "SELECT * FROM versions",
    "scd2_current": SNAPSHOT_VERSIONS + "SELECT * FROM versions WHERE dbt_valid_to IS NULL",
    "scd2_late_runs": SNAPSHOT_VERSIONS + "SELECT * FROM versions",
    "csv_round_trip_races": with_("SELECT year, round, event_name, country, CAST(date AS DATE) AS date FROM raw_races", **RACES_STACK),
    "csv_round_trip_laps": with_("SELECT * FROM raw_fastest_laps", **LAPS_STACK),
    "ingest_laps": with_("SELECT year, round, event_name, driver_code, team, "
                         "CAST(CAST(lap_time_seconds AS DECIMAL(18,6)) AS DOUBLE) AS lap_time_seconds FROM laps_like", laps_like=LAPS_LIKE),
    "stored_order": with_("SELECT season_year, driver_code, total_points, championship_position, "
                          "row_number() OVER (PARTITION BY season_year ORDER BY championship_position) AS stored_place FROM driver_standings",
                          **STANDINGS_STACK),
})

ORACLES.update({
    "stream_incremental_results": ORACLES["incremental_results"],
    "stream_marked_races": with_("SELECT * FROM stg_results", **RESULTS_STACK),
    "warehouse_driver_standings": with_("SELECT * FROM driver_standings", raw_results=RESULTS_LIKE,
                                        kept=FIRST_BATCH.format(part="year, round", batch=BATCH_OF),
                                        stg_results=stg_results_sql("kept"), driver_standings=DRIVER_STANDINGS),
})
