"""Command line: build the warehouse from landed files, then query it.

    python -m paddock build --landing DIR --warehouse DIR [--seasons 2024 2025] [--season 2025]
    python -m paddock sql --warehouse DIR [--output DIR] "SELECT ... FROM driver_standings ..."
    python -m paddock describe --warehouse DIR driver_standings

``build`` reads ``raw_races``, ``raw_results`` and ``raw_fastest_laps`` from the landing folder, each
as ``<name>.csv`` (header, the seed form), ``<name>.json`` (one record per line) or ``<name>/`` (parquet),
with explicit schemas; a missing table is an error unless ``--allow-missing`` says it lands empty.
``--seasons`` limits the run, by default to all landed seasons; ``--season`` stamps rows that carry no
year. It then runs ``build_all`` (coerce -> raw -> staging -> marts -> expectations) and prints the
expectation report; a failed expectation exits non-zero. ``sql`` runs a guarded query (queries only)
over the stored marts: the whole result goes to ``--output`` as CSV files, or else at most ``--limit``
rows are printed, and a cut is stated.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from paddock import schemas
from paddock.functions.columns import nan_to_null
from paddock.session import path_exists
from paddock.sources.readers import (
    conform,
    read_json,
    read_parquet,
    read_seed_fastest_laps,
    read_seed_races,
    read_seed_results,
)

RAW = {"raw_races": (schemas.RAW_RACES, read_seed_races),
       "raw_results": (schemas.RAW_RESULTS, read_seed_results),
       "raw_fastest_laps": (schemas.RAW_FASTEST_LAPS, read_seed_fastest_laps)}


def read_landing(spark: SparkSession, landing: str, name: str, allow_missing: bool = False) -> DataFrame:
    schema, read_seed = RAW[name]
    base = landing.rstrip("/") + "/" + name
    if path_exists(spark, base + ".csv"):
        df = read_seed(spark, base + ".csv")
    elif path_exists(spark, base + ".json"):
        df = read_json(spark, base + ".json", schema)
    elif path_exists(spark, base):
        df = read_parquet(spark, base, schema)
    elif allow_missing:
        df = spark.createDataFrame([], schema)
    else:
        raise FileNotFoundError(f"{base}: no .csv, .json or parquet folder")
    df = conform(df, schema)
    for f in schema.fields:  # a landed NaN is a missing number
        if f.dataType.simpleString() == "double":
            df = df.withColumn(f.name, nan_to_null(f.name))
    return df


def _views(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    from paddock.plans.build import MARTS, Warehouse

    wh = Warehouse(spark, warehouse)
    return {n: wh.mart(n).read() for n in MARTS if wh.mart(n).exists()}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="paddock")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--landing", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--seasons", type=int, nargs="*")
    b.add_argument("--season", type=int)
    b.add_argument("--allow-missing", action="store_true")
    q = sub.add_parser("sql")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--limit", type=int, default=100)
    q.add_argument("--output")
    q.add_argument("query")
    d = sub.add_parser("describe")
    d.add_argument("--warehouse", required=True)
    d.add_argument("table")
    args = ap.parse_args(argv)

    from paddock.session import get_spark

    spark = get_spark("paddock-cli")
    if args.cmd == "build":
        from paddock.operators.expectations import ExpectationFailed
        from paddock.plans.build import build_all

        try:
            landing = {n: read_landing(spark, args.landing, n, args.allow_missing) for n in RAW}
            wh = build_all(spark, landing, args.seasons, args.warehouse, season=args.season)
        except (ExpectationFailed, FileNotFoundError) as e:
            print(str(e), file=sys.stderr)
            return 1
        wh.report.show(truncate=False)
        return 0
    from paddock.plans import adhoc

    views = _views(spark, args.warehouse)
    if args.cmd == "describe":
        adhoc.register_views(views)
        print("\n".join(adhoc.describe(spark, args.table)))
        return 0
    text, failed = adhoc.answer(spark, args.query, views, args.limit, args.output)
    print(text)
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
