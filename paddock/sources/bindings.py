"""Reference-shaped inputs derived from the driver's test tables (see FIXTURES.md §C).

Each binding is a lazy DataFrame over the parquet tables in ``sf_dir``; its work grows with them.
Only the columns a binding needs are selected, so the scans are pruned; the joins are plain
equi-joins that Spark plans as sort-merge or, when AQE measures a side under the broadcast
threshold, as broadcast hash joins (no unchecked ``broadcast`` hints).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.columns import FINISHED_STATUS, season_week

# Fixture parameters (not reference values): the two cut dates that split orders into three
# cumulative landing batches. Both fall inside a round, so a later batch carries late rows.
BATCH_CUTS = ("1998-06-17", "2000-03-09")

# The colour table of the dashboard, in its natural order, and the default colour.
TEAM_COLOURS = (
    ("Red Bull Racing", "#3671C6"),
    ("Ferrari", "#E8002D"),
    ("Mercedes", "#27F4D2"),
    ("Alpine", "#FF87BC"),
    ("McLaren", "#FF8000"),
    ("Alfa Romeo", "#C92D4B"),
    ("Aston Martin", "#229971"),
    ("Haas F1 Team", "#B6BABD"),
    ("AlphaTauri", "#6692FF"),
    ("Williams", "#64C4FF"),
    ("Aston Martin Aramco", "#229971"),
    ("Kick Sauber", "#C92D4B"),
    ("RB", "#6692FF"),
    ("Visa Cash App RB", "#6692FF"),
    ("Alpine F1 Team", "#FF87BC"),
    ("Haas", "#B6BABD"),
)
DEFAULT_COLOUR = "#e10600"

RESULT_TIEBREAKS = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
LAP_TIEBREAKS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def batch_number(ts_col="o_orderdate"):
    """Landing batch of an order: 1 before the first cut, 2 before the second, else 3."""
    c = F.col(ts_col)
    return (F.when(c < F.lit(BATCH_CUTS[0]).cast("timestamp_ntz"), 1)
            .when(c < F.lit(BATCH_CUTS[1]).cast("timestamp_ntz"), 2).otherwise(3))


def _cut(i: int):
    return F.lit(BATCH_CUTS[i]).cast("timestamp_ntz")


def upto_batch(batch: int, ts_col="o_orderdate"):
    """Cumulative batches 1..``batch`` as a plain range on the order date, so the predicate reaches
    the orders scan as a pushed filter (a CASE over the date would not)."""
    if batch > len(BATCH_CUTS):
        return F.lit(True)
    return F.col(ts_col) < _cut(batch - 1)


def in_batch(batch: int, ts_col="o_orderdate"):
    """Exactly batch ``batch`` as a date range (pushed to the scan)."""
    c = F.col(ts_col)
    cond = F.lit(True)
    if batch >= 2:
        cond = cond & (c >= _cut(batch - 2))
    if batch <= len(BATCH_CUTS):
        cond = cond & (c < _cut(batch - 1))
    return cond


def year_range(year: int, ts_col="o_orderdate"):
    """Rows of one calendar year as a date range (pushed to the scan, unlike ``year(ts) = y``)."""
    c = F.col(ts_col)
    return (c >= F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")) & \
        (c < F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz"))


def line_facts(spark: SparkSession, sf_dir: str, li_cols) -> DataFrame:
    """lineitem ⋈ orders ⋈ supplier ⋈ nation with the calendar fields of each line."""
    li = table(spark, sf_dir, "lineitem", *li_cols)
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    supplier = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # Each dimension joins the fact stream as a plain scan, so its size estimate is the file size and
    # a small one is broadcast statically (a pre-joined supplier x nation would be estimated as a
    # product and force a shuffle of the fact side). Large sides fall back to sort-merge joins.
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .withColumn("year", F.year("o_orderdate").cast("int"))
            .withColumn("round", season_week("o_orderdate"))
            .withColumn("event_name", F.concat(F.lit("Round "), F.col("round").cast("string"))))


def landed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_facts`` with all that ``results_like`` and ``laps_like`` read, and nothing else: to be written once for both."""
    li = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    return line_facts(spark, sf_dir, li).select("year", "round", "event_name", *li, "s_name", "n_name", "o_orderdate")


def results_like(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """raw_results-shaped rows: one per line item; driver = supplier, team = its nation. ``facts``: ``landed_facts``."""
    f = facts if facts is not None else line_facts(spark, sf_dir, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                    "l_extendedprice", "l_returnflag", "l_linestatus"))
    position = (F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
                .otherwise(F.ceil(F.col("l_quantity") / F.lit(2.5)).cast("double")))
    return f.select(
        "year", "round", "event_name",
        F.col("l_suppkey").cast("string").alias("driver_number"),
        F.col("s_name").alias("driver_code"),
        F.concat(F.lit("Driver "), F.col("s_name")).alias("full_name"),
        F.col("n_name").alias("team"),
        position.alias("position"),
        (F.lit(51.0) - F.col("l_quantity")).alias("points"),
        F.when(F.col("l_linestatus") == "F", F.lit(FINISHED_STATUS)).otherwise(F.lit("Retired")).alias("status"),
        *RESULT_TIEBREAKS, "o_orderdate")


def laps_like(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Lap rows: one per line item, lap time = extended price / 1000 seconds. ``facts``: ``landed_facts``."""
    f = facts if facts is not None else line_facts(spark, sf_dir, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                    "l_extendedprice"))
    return f.select(
        "year", "round", "event_name",
        F.col("s_name").alias("driver_code"),
        F.col("n_name").alias("team"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("lap_time_seconds"),
        *LAP_TIEBREAKS, "o_orderdate")


def races_like(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """raw_races-shaped calendar: one row per (year, round) of orders; the country is the nation
    with the least key among the race's customers; the date is the race's first order day."""
    o = orders if orders is not None else table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # the least key by a hash aggregate over the orders; its name joins the few rows that are left
    races = (o.select("o_custkey", "o_orderdate")
             .join(cust, F.col("o_custkey") == F.col("c_custkey"))
             .join(nation.select("n_nationkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
             .groupBy(F.year("o_orderdate").cast("int").alias("year"), season_week("o_orderdate").alias("round"))
             .agg(F.min("c_nationkey").alias("_nation"), F.min("o_orderdate").cast("date").alias("date")))
    return (races.join(nation, F.col("_nation") == F.col("n_nationkey"))
            .select("year", "round", F.concat(F.lit("Round "), F.col("round").cast("string")).alias("event_name"),
                    F.col("n_name").alias("country"), "date"))


def transfers_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_results-shaped rows in which drivers change teams: driver = supplier, team = the nation of the
    order's customer."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    code = F.col("l_suppkey").cast("string")
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.year("o_orderdate").cast("int").alias("year"), season_week("o_orderdate").alias("round"),
                    F.lit("").alias("event_name"), code.alias("driver_number"), F.concat(F.lit("D"), code).alias("driver_code"),
                    F.concat(F.lit("Driver "), code).alias("full_name"), F.col("n_name").alias("team"),
                    F.lit(1.0).alias("position"), F.lit(0.0).alias("points"), F.lit(FINISHED_STATUS).alias("status"),
                    "o_orderdate", "l_orderkey", "l_linenumber"))


def landing_with_gaps(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landed frames as an ingestion may find them: drivers without a code, NaN positions, and sessions of
    testing events, which carry round 0 in the calendar and in the results."""
    f = line_facts(spark, sf_dir, ("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"))
    testing = F.col("l_linenumber") == 7
    results = f.select(
        "year", F.when(testing, 0).otherwise(F.col("round")).alias("round"), "event_name",
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey").cast("string")).alias("driver_number"),
        F.when(F.col("l_suppkey") % 3 != 0, F.col("s_name")).alias("driver_code"),
        F.concat(F.lit("Driver "), F.col("s_name")).alias("full_name"), F.col("n_name").alias("team"),
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.ceil(F.col("l_quantity") / F.lit(2.5)).cast("double")).alias("position"),
        F.when(F.col("l_returnflag") == "A", F.lit(float("nan"))).otherwise(F.lit(51.0) - F.col("l_quantity")).alias("points"),
        F.when(F.col("l_linestatus") == "F", F.lit(FINISHED_STATUS)).alias("status"))
    races = races_like(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    days = races.groupBy("year").agg(F.lit(0).alias("round"), F.lit("Testing").alias("event_name"), F.first("country").alias("country"),
                                     F.min("date").alias("date"))
    laps = results.select("year", "round", "event_name", "driver_code", "team", F.lit(80.0).alias("lap_time_seconds"))
    return {"raw_races": races.unionByName(days), "raw_results": results, "raw_fastest_laps": laps}


def landing_with_lap_times(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landed frames whose laps, one per line item, carry their time as a day-time interval."""
    seconds = F.col("lap_time_seconds").cast("decimal(18,6)")
    nothing = F.lit(0)
    laps = laps_like(spark, sf_dir).withColumn("lap_time", F.make_dt_interval(nothing, nothing, nothing, seconds))
    races = races_like(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    return {"raw_races": races, "raw_results": results_like(spark, sf_dir).where("false"),
            "raw_fastest_laps": laps.select("year", "round", "event_name", "driver_code", "team", "lap_time")}


def landing_in_thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_results-shaped rows with the time they land; ``_third`` (0..2) spreads each race over three landings, an
    hour apart."""
    third = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(3)).cast("int")
    landed = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), third, F.lit(0), F.lit(0))
    return results_like(spark, sf_dir).withColumn("_third", third).withColumn("landed_at", landed)


def race_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One marker per race: how many rows it has, and the time that closes it; by the round, a marker lands with the
    first, second or third part of the rows."""
    races = results_like(spark, sf_dir).groupBy("year", "round").agg(F.count("*").alias("expected"))
    return (races.withColumn("marked_at", F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.lit(3), F.lit(0), F.lit(0)))
            .withColumn("_third", (F.col("round") % 3).cast("int")))


def orders_in_batch(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Orders landed up to cumulative batch ``batch`` (1..3)."""
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").where(upto_batch(batch))


def order_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Every calendar year from the first to the last order (one single-row aggregate)."""
    r = table(spark, sf_dir, "orders", "o_orderdate").agg(
        F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")).first()
    return [] if r.lo is None else list(range(r.lo, r.hi + 1))


def events_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values for running totals: sums go through DECIMAL(18,2) so they are exact."""
    return table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value") \
        .withColumn("value_dec", F.col("value").cast("decimal(18,2)"))


def customer_priority_snapshots(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """One snapshot source per year: each customer's latest order priority in that year, by
    (order date, order key). Columns: snapshot_year, o_custkey, o_orderpriority. With ``year`` only
    that year's orders are read (date range pushed to the scan)."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if year is not None:
        o = o.where(year_range(year))
    return (o.groupBy(F.year("o_orderdate").cast("int").alias("snapshot_year"), "o_custkey")
            .agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("o_orderpriority")))


def team_colours_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """team -> colour: nations with keys 0..15 take the colour list in order, the rest get none."""
    colours = spark.createDataFrame([(i, c) for i, (_, c) in enumerate(TEAM_COLOURS)], "idx INT, colour STRING")
    return (table(spark, sf_dir, "nation", "n_nationkey", "n_name")
            .join(colours, F.col("n_nationkey") == F.col("idx"))
            .select(F.col("n_name").alias("team"), "colour"))
