"""Run the mart's jobs: ``python -m txnmart <job> ...`` or through spark-submit.

Every job prints one line of JSON. A job with nothing to work on exits 0 and says so;
with ``--strict`` it exits 1.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txnmart.operators import reports
from txnmart.plans import mart
from txnmart.scratch import clear_scratch
from txnmart.session import mart_session
from txnmart.sinks.jdbc import JdbcTarget
from txnmart.sinks.store import MartStore
from txnmart.sources.files import path_exists, write_csv
from txnmart.sources.synthetic import sequential_ids, synthetic_transactions
from txnmart.streaming.ingest import csv_stream, ingest_available
from txnmart.streaming.totals import daily_totals_stream, total_available, utc_instant, write_available


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txnmart", description=__doc__)
    top.add_argument("--master", help="Spark master; leave out under spark-submit")
    top.add_argument(
        "--conf", action="append", default=[], metavar="NAME=VALUE", help="Spark setting"
    )
    top.add_argument("--strict", action="store_true", help="fail when a job is skipped")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *with_options: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=about)
        if "mart" in with_options:
            p.add_argument("--mart", required=True, help="folder of the published tables")
        if "source" in with_options:
            p.add_argument("--source", required=True, help="CSV file, folder or pattern")
        if "time" in with_options:
            now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
            p.add_argument("--load-time", default=now, help="UTC, yyyy-mm-dd hh:mm:ss")
        return p

    ingest = job("ingest", "CSV to the raw table", "mart", "source")
    ingest.add_argument("--incremental", action="store_true", help="add only new ids")
    transform = job("transform", "clean raw rows and append the new ones to silver", "mart")
    load = job("load", "rebuild the star and publish it", "mart", "time")
    load.add_argument("--incremental", action="store_true", help="extend it instead")
    run = job("run", "ingest, transform and load", "mart", "source", "time")
    for p in (transform, run):
        p.add_argument("--defaults", action="store_true", help="blank text to NULL or a default")
        p.add_argument("--dedup", action="store_true", help="one row per id")
        p.add_argument(
            "--days", nargs=2, metavar=("FIRST", "LAST"),
            help="check the business rules, with transactions between these days; rows that "
            "break one go to the quarantine table",
        )
    for p in (load, run):
        p.add_argument(
            "--by-email", action="store_true", help="find customers by email alone; kept by "
            "incremental loads",
        )
    star = job("load-accounts", "publish the account star from two CSV feeds", "mart", "source")
    star.add_argument("--accounts", required=True, help="CSV file, folder or pattern of the accounts")
    stream = job("stream", "merge CSV files that have arrived into silver", "mart", "source")
    stream.add_argument("--state", required=True, help="checkpoint folder of the stream")
    stream.add_argument("--files-per-batch", type=int, help="most files of a micro-batch")
    totals = job("stream-totals", "daily totals of an event stream, each day once it is final")
    totals.add_argument("--source", required=True, help="folder or pattern of parquet files")
    into = totals.add_mutually_exclusive_group(required=True)
    into.add_argument("--output", help="folder of the totals")
    into.add_argument("--mart", help="mart whose table stream_days has them, late events counted too")
    totals.add_argument("--state", required=True, help="checkpoint folder of the stream")
    totals.add_argument("--lateness", default="1 hour")
    job("history", "bring the type-2 table of customers up to date with silver", "mart")
    database = job("load-database", "send the star to a database over JDBC", "mart")
    database.add_argument("--url", required=True)
    database.add_argument("--driver", default="org.postgresql.Driver")
    database.add_argument("--schema", default="finance")
    database.add_argument("--connections", type=int, default=8)
    database.add_argument("--incremental", action="store_true", help="send only new rows")
    job("totals", "bring the daily totals up to date with silver", "mart")
    audit = job("audit", "rows written per version and table, newest first, as JSON lines", "mart")
    audit.add_argument("--versions", type=int, help="only so many newest versions; default: all")
    job("expire", "delete data only older versions use", "mart").add_argument(
        "--keep", type=int, required=True, help="versions to keep readable"
    )
    spenders = job("top-spenders", "largest monthly totals per customer", "mart")
    spenders.add_argument("--limit", type=int, default=20)

    generate = jobs.add_parser("generate", help="write synthetic transactions as CSV")
    generate.add_argument("--rows", type=int, default=5000)
    today = dt.date.today()
    generate.add_argument(
        "--start", type=dt.date.fromisoformat, default=today - dt.timedelta(days=730)
    )
    generate.add_argument("--end", type=dt.date.fromisoformat, default=today)
    generate.add_argument("--output", required=True)
    generate.add_argument("--customers", type=int, help="default: one per ten rows")
    generate.add_argument("--merchants", type=int, help="default: one per hundred rows")
    generate.add_argument("--seed", type=int, default=0)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    conf = dict(setting.split("=", 1) for setting in args.conf)
    spark = mart_session(f"txnmart-{args.job}", args.master, **conf)
    try:
        return run_job(spark, args)
    finally:
        clear_scratch(spark)


def stream(
    store: MartStore, source: str, state: str, files_per_batch: int | None = None
) -> mart.StepResult:
    if not path_exists(store.spark, source):
        return mart.StepResult(mart.SKIPPED_NO_SOURCE)
    before = store.at().rows(mart.SILVER)
    files = csv_stream(store.spark, source, files_per_batch)
    ingest_available(store, mart.SILVER, files, state)
    at = store.at()
    rows = at.rows(mart.SILVER) - before
    return mart.StepResult(mart.LOADED if rows else mart.UNCHANGED, rows, at.version)


def stream_totals(spark: SparkSession, args: argparse.Namespace) -> None:
    """Events have a zone-less UTC ``ts`` and a ``value``; the schema is that of the files that
    are there."""
    schema = spark.read.parquet(args.source).schema
    events = spark.readStream.schema(schema).parquet(args.source)
    events = events.withColumn("ts", utc_instant(F.col("ts")))
    if args.mart:
        total_available(MartStore(spark, args.mart), events, args.lateness, args.state)
        return
    write_available(daily_totals_stream(events, args.lateness), args.output, args.state)


def checks_of(args: argparse.Namespace) -> mart.Checks:
    return mart.Checks(args.defaults, args.dedup, tuple(args.days) if args.days else None)


def run_job(spark: SparkSession, args: argparse.Namespace) -> int:
    store = MartStore(spark, args.mart) if getattr(args, "mart", None) else None
    result = None
    if args.job == "ingest":
        step = mart.ingest_incremental if args.incremental else mart.ingest
        result = step(store, args.source)
    elif args.job == "transform":
        result = mart.transform(store, checks_of(args))
    elif args.job == "load":
        step = mart.load_incremental if args.incremental else mart.load
        result = step(store, args.load_time, by_email=args.by_email)
    elif args.job == "load-accounts":
        result = mart.load_accounts(store, args.accounts, args.source)
    elif args.job == "history":
        result = mart.refresh_history(store)
    elif args.job == "stream-totals":
        stream_totals(spark, args)
    elif args.job == "totals":
        result = mart.refresh_totals(store)
    elif args.job == "run":
        result = mart.run(
            store, args.source, args.load_time, checks_of(args), by_email=args.by_email
        )
    elif args.job == "stream":
        result = stream(store, args.source, args.state, args.files_per_batch)
    elif args.job == "load-database":
        target = JdbcTarget(args.url, args.driver, connections=args.connections)
        print(json.dumps(mart.load_database(store, target, args.schema, args.incremental)))
    elif args.job == "audit":
        audit = store.load_audit().orderBy(F.desc("version"), "table_name")
        if args.versions:
            audit = audit.where(F.col("version") > store.at().version - args.versions)
        for line in audit.toJSON().toLocalIterator():
            print(line)
    elif args.job == "expire":
        print(json.dumps({"job": "expire", "deleted": store.expire(args.keep)}))
    elif args.job == "top-spenders":
        at = store.at()
        star = [at.read(t) for t in (mart.FACT, "dim_customer", "dim_date")]
        spend = reports.monthly_spend(*star)
        reports.top_spenders(spend, args.limit).show(args.limit, truncate=False)
    elif args.job == "generate":
        rows = synthetic_transactions(
            sequential_ids(spark, args.rows),
            args.customers or max(1, args.rows // 10),
            args.merchants or max(1, args.rows // 100),
            args.start,
            args.end,
            args.seed,
        )
        write_csv(rows, args.output)
    if result is None:
        return 0
    print(json.dumps({"job": args.job, **vars(result)}))
    return 1 if args.strict and result.status.startswith("SKIPPED") else 0


if __name__ == "__main__":
    sys.exit(main())
