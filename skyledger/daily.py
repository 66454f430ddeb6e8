"""One daily run from the command line: extract, load, then the warehouse.

    spark-submit skyledger/daily.py --root s3a://lake/air --ds 2024-01-16 --incremental \\
        --jdbc-url jdbc:postgresql://host/db --jdbc-schema bookings --jdbc-property user=etl
"""

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from skyledger.plans.staging import run_staging
from skyledger.plans.warehouse import run_warehouse
from skyledger.schemas import TABLES
from skyledger.session import build_session
from skyledger.sources.extract import Source, jdbc_source, parquet_source, plan_splits, table_source
from skyledger.sources.store import Store


def run_day(
    spark: SparkSession,
    root: str,
    source: Source,
    ds: str,
    run_ts: dt.datetime,
    incremental: bool = False,
    on_duplicates: str = "error",
    rules: bool = True,
    **warehouse,
) -> DataFrame:
    """Staging and warehouse of one day under `root`; returns the status of the staging steps."""
    store = Store(spark, f"{root}/tables")
    status = run_staging(
        store, source, f"{root}/landing", ds, run_ts, incremental, on_duplicates=on_duplicates, rules=rules
    )
    run_warehouse(store, run_ts, **warehouse)
    return status


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--root", required=True, help="folder of the landing zone and the tables")
    parser.add_argument("--ds", required=True, help="run date; an incremental run reads the day before it")
    parser.add_argument("--incremental", action="store_true")
    parser.add_argument("--run-ts", help="time stamped on new versions, default now (UTC)")
    parser.add_argument("--zone", default="UTC", help="zone of the local date and time columns")
    parser.add_argument("--versions", choices=["all", "current", "as_of"], default="current")
    parser.add_argument("--passenger-join", choices=["natural", "surrogate"], default="surrogate")
    parser.add_argument("--truncate", action="store_true", help="cut times to whole seconds")
    parser.add_argument("--on-duplicates", choices=["error", "latest"], default="error")
    parser.add_argument("--no-rules", action="store_true", help="load rows that break a rule of their table")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--source-parquet", help="folder with one Parquet folder per table")
    source.add_argument("--source-database", help="catalog database with the tables")
    source.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-splits", type=int, default=32, help="ranges that a table loaded before is read in")
    parser.add_argument("--jdbc-schema", default="bookings")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
    return parser.parse_args()


def known_splits(store: Store, count: int) -> dict[str, list[str]]:
    """Ranges of the first key column of every staging table that has been loaded."""
    loaded = [t for t in TABLES.values() if store.exists(f"stg.{t.name}")]
    return {t.name: plan_splits(store.read(f"stg.{t.name}"), t.key[0], count) for t in loaded}


def _source(spark: SparkSession, args: argparse.Namespace) -> Source:
    if args.source_parquet:
        return parquet_source(spark, args.source_parquet)
    if args.source_database:
        return table_source(spark, args.source_database)
    # Of a table that was never loaded no key is known; its first load is by one task.
    splits = known_splits(Store(spark, f"{args.root}/tables"), args.jdbc_splits)
    first = [name for name in TABLES if name not in splits]
    properties = dict(p.split("=", 1) for p in args.jdbc_property)
    return jdbc_source(spark, args.jdbc_url, args.jdbc_schema, predicates=splits, single=first, **properties)


def main() -> None:
    args = _arguments()
    spark = build_session("daily run")
    run_ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else dt.datetime.now(dt.timezone.utc)
    status = run_day(
        spark,
        args.root,
        _source(spark, args),
        args.ds,
        run_ts.replace(tzinfo=None),
        args.incremental,
        args.on_duplicates,
        not args.no_rules,
        zone=args.zone,
        versions=args.versions,
        truncate=args.truncate,
        passenger_join=args.passenger_join,
    )
    status.show(truncate=False)


if __name__ == "__main__":
    main()
