"""One query per operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnmart.functions import cleaning
from txnmart.operators import accounts, delta, dims, facts, history, quality, reports
from txnmart.operators.keys import dense_key
from txnmart.plans import mart
from txnmart.schemas import COLUMNS, ID, TRANSACTION
from txnmart.scratch import scratch_path, scratch_root, staged
from txnmart.sinks import jdbc
from txnmart.sinks.store import MartStore
from txnmart.sources import files, synthetic
from txnmart.sources.testtables import (
    before,
    order_transactions,
    table,
    text_transactions,
    transactions,
)
from txnmart.streaming import ingest as stream_ingest_jobs
from txnmart.streaming import totals as stream_totals

# What had been loaded before the whole feed is delivered again: most of it, or little
# enough that the feed brings new customers, merchants and dates.
HISTORY_END = "2000-01-01"
FIRST_MONTH_END = "1995-02-01"
LOAD_TS = "2026-03-12 08:00:00"
RULE_DAYS = ("1995-01-01", "2000-12-31")
SYNTH_DAYS = (dt.date(2024, 3, 12), dt.date(2026, 3, 12))
OLD_PRIORITY, OLD_START, OLD_ENDS = "0-OLD", "1990-01-01", ("1991-01-01", "1998-06-01")
TOP = 20
DELIVERED, STREAMED = "lz4", "gzip"  # how CSV deliveries are compressed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(transactions(spark, sf_dir))


def staged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written table, for operators that read it several times."""
    return staged(silver(spark, sf_dir), "silver")


def new_store(spark: SparkSession) -> MartStore:
    return MartStore(spark, scratch_path(spark, "mart"))


def database(spark: SparkSession) -> jdbc.JdbcTarget:
    """The database named in the session; in a local session, else, an embedded Derby in
    the scratch folder, which only this process can see."""
    url = spark.conf.get("spark.txnmart.jdbc.url", None)
    if url:
        return jdbc.JdbcTarget(url, spark.conf.get("spark.txnmart.jdbc.driver"))
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.txnmart.jdbc.url and spark.txnmart.jdbc.driver")
    folder = scratch_path(spark, "derby").removeprefix("file:")
    system = spark.sparkContext._jvm.java.lang.System
    system.setProperty(
        "derby.stream.error.file", f"{scratch_root(spark).removeprefix('file:')}/derby.log"
    )
    return jdbc.JdbcTarget(
        f"jdbc:derby:{folder};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    )


def database_table() -> str:
    return f"transactions_{uuid.uuid4().hex[:12]}"


# --- sources and sinks


@query
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(transactions(spark, sf_dir), path)
    return files.csv_scan(spark, path).select(COLUMNS)


@query
def csv_scan_reordered(spark, sf_dir):
    """The feed in two deliveries, the second with its columns in another order."""
    feed, folder = staged(transactions(spark, sf_dir), "feed"), scratch_path(spark, "csv")
    early = F.col("transaction_date") < F.lit(HISTORY_END).cast("date")
    files.write_csv(feed.where(early), f"{folder}/1")
    files.write_csv(feed.where(~early).select(*reversed(COLUMNS)), f"{folder}/2")
    return files.csv_scan(spark, f"{folder}/*").select(COLUMNS)


@query
def parquet_scan(spark, sf_dir):
    return files.parquet_scan(spark, f"{sf_dir}/lineitem.parquet", schema=None)


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw")
    transactions(spark, sf_dir).write.mode("overwrite").parquet(path)
    return files.parquet_scan(spark, path, TRANSACTION)


@query
def staged_publish(spark, sf_dir):
    """Replace a table by a result computed from the table itself."""
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    store.publish({mart.SILVER: before(feed, HISTORY_END)})
    store.publish({mart.SILVER: delta.merged(store.read(mart.SILVER), feed)})
    return store.read(mart.SILVER)


@query
def curated_replace(spark, sf_dir):
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    for part in (before(feed, FIRST_MONTH_END), feed):
        store.publish({dims.MERCHANT.table: dims.MERCHANT.build(part)})
    return store.read(dims.MERCHANT.table)


@query
def jdbc_append(spark, sf_dir):
    """Load the history, then append what the whole feed adds to it."""
    feed, target, name = staged_silver(spark, sf_dir), database(spark), database_table()
    jdbc.create(feed, target, name)
    jdbc.append(before(feed, HISTORY_END), target, name)
    jdbc.append(feed, target, name, key=ID)
    return jdbc.jdbc_table(spark, target, name, split_by=ID)


@query
def jdbc_full_reload(spark, sf_dir):
    """Replace loaded history by the whole feed; an empty load then changes nothing."""
    feed, target, name = staged_silver(spark, sf_dir), database(spark), database_table()
    jdbc.create(feed, target, name)
    jdbc.full_reload(before(feed, HISTORY_END), target, name)
    jdbc.full_reload(feed, target, name)
    jdbc.full_reload(feed.where(F.lit(False)), target, name)
    return jdbc.jdbc_table(spark, target, name, split_by=ID)


@query
def jdbc_table_count(spark, sf_dir):
    feed, target, name = staged_silver(spark, sf_dir), database(spark), database_table()
    jdbc.create(feed, target, name)
    empty = jdbc.is_empty(spark, target, name)
    jdbc.append(feed, target, name)
    return jdbc.table_count(spark, target, name).withColumn("empty_before", F.lit(empty))


@query
def synth_transactions(spark, sf_dir):
    """A synthetic twin of every line item, over as many customers and merchants."""
    ids = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(ID)
    )
    return synthetic.synthetic_transactions(
        ids,
        table(spark, sf_dir, "customer").count(),
        table(spark, sf_dir, "supplier").count(),
        *SYNTH_DAYS,
        seed=7,
    )


@query
def row_count_observed(spark, sf_dir):
    """Rows in and out of the batch de-duplication, counted by the write that runs it."""
    read, kept = Observation(), Observation()
    one = F.count(F.lit(1)).alias("rows")
    raw = transactions(spark, sf_dir).observe(read, one)
    written = staged(raw, "observed-raw")
    staged(delta.dedup_batch(cleaning.clean(written)).observe(kept, one), "observed-silver")
    rows = [("raw", read.get["rows"]), ("deduplicated", kept.get["rows"])]
    return spark.createDataFrame(rows, "step string, row_count long")


# --- projections and functions


@query
def cast_project(spark, sf_dir):
    return cleaning.cast_project(text_transactions(spark, sf_dir))


@query
def clean_strings(spark, sf_dir):
    return cleaning.clean_strings(transactions(spark, sf_dir))


@query
def load_timestamp(spark, sf_dir):
    return cleaning.with_load_timestamp(silver(spark, sf_dir), LOAD_TS)


@query
def date_parts(spark, sf_dir):
    dated = transactions(spark, sf_dir).select(ID, "transaction_date")
    return cleaning.date_parts(dated, quarter=True)


@query
def null_handling(spark, sf_dir):
    return cleaning.null_handling(cleaning.clean(text_transactions(spark, sf_dir)))


@query
def enrich_tax_discount(spark, sf_dir):
    enriched = cleaning.enrich_tax_discount(transactions(spark, sf_dir, rates=True))
    money = [F.col(c).cast("double").alias(c) for c in ("net_amount", "gross_amount")]
    return enriched.select(ID, "transaction_amount", "discount", "tax", *money)


# --- joins, distinct, merge


@query
def anti_join_new(spark, sf_dir):
    feed = staged_silver(spark, sf_dir)
    return delta.new_rows(feed, before(feed, HISTORY_END))


@query
def left_join_merchant(spark, sf_dir):
    feed = staged_silver(spark, sf_dir)
    joined = facts.join_merchant(feed, dims.MERCHANT.build(feed))
    return joined.select(ID, "merchant_name", "merchant_id")


@query
def left_join_customer(spark, sf_dir):
    feed = staged_silver(spark, sf_dir)
    joined = facts.join_customer(feed, dims.CUSTOMER.build(feed))
    return joined.select(ID, "customer_name", "customer_email", "customer_id")


@query
def distinct_merchants(spark, sf_dir):
    return dims.merchant_members(silver(spark, sf_dir))


@query
def distinct_dates(spark, sf_dir):
    return dims.date_members(silver(spark, sf_dir))


@query
def first_per_key(spark, sf_dir):
    return dims.first_per_key(silver(spark, sf_dir), "customer_email", "customer_name")


@query
def dedup_batch(spark, sf_dir):
    return delta.dedup_batch(staged_silver(spark, sf_dir))


@query
def union_by_name(spark, sf_dir):
    """Silver with the order-level feed, whose columns come in another order."""
    orders = cleaning.clean(order_transactions(spark, sf_dir)).select(*reversed(COLUMNS))
    return delta.union_by_name(silver(spark, sf_dir), orders)


@query
def incremental_merge(spark, sf_dir):
    """History, then the whole feed, then the feed again and an empty batch."""
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    store.append(mart.SILVER, before(feed, HISTORY_END))
    for batch in (feed, feed, feed.where(F.lit(False))):
        mart.append_new(store, mart.SILVER, batch)
    return store.read(mart.SILVER)


# --- keys, dimensions, facts


@query
def dense_key_ids(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    ids = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(ID)).distinct()
    return dense_key(ids, ID, "dense_id")


QUERIES["dense_key"] = QUERIES.pop("dense_key_ids")


@query
def dim_customer(spark, sf_dir):
    return dims.CUSTOMER.build(silver(spark, sf_dir))


@query
def dim_merchant(spark, sf_dir):
    return dims.MERCHANT.build(silver(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return dims.DATE.build(silver(spark, sf_dir))


def star(feed: DataFrame) -> list[DataFrame]:
    return [d.build(feed) for d in dims.DIMENSIONS]


@query
def fact_transactions(spark, sf_dir):
    feed = staged_silver(spark, sf_dir)
    return facts.fact_transactions(feed, *star(feed), LOAD_TS)


@query
def fact_transactions_by_email(spark, sf_dir):
    feed = staged_silver(spark, sf_dir)
    return facts.fact_transactions(feed, *star(feed), LOAD_TS, by_email=True)


@query
def mart_end_to_end(spark, sf_dir):
    """CSV to published fact through the three daily jobs."""
    path = scratch_path(spark, "csv")
    files.write_csv(transactions(spark, sf_dir), path, compression=DELIVERED)
    store = new_store(spark)
    mart.run(store, path, LOAD_TS).require()
    return store.read(mart.FACT)


@query
def mart_validated_run(spark, sf_dir):
    """The untidy feed through ingest and a transform with defaults, de-duplication and rules,
    delivered twice: silver, and the quarantine with its reasons."""
    path = scratch_path(spark, "csv")
    files.write_csv(text_transactions(spark, sf_dir), path, compression=DELIVERED)
    store = new_store(spark)
    for _ in range(2):
        mart.ingest(store, path).require()
        mart.transform(store, mart.Checks(defaults=True, dedup=True, days=RULE_DAYS))
    good = store.read(mart.SILVER).withColumn("violations", F.lit(""))
    return good.unionByName(store.read(mart.QUARANTINE))


@query
def fact_incremental_by_email(spark, sf_dir):
    """A star loaded by email with the first month, then extended by the whole feed."""
    feed, store = staged_silver(spark, sf_dir), new_store(spark)
    for batch in (before(feed, FIRST_MONTH_END), feed):
        mart.append_new(store, mart.SILVER, batch)
        mart.load_incremental(store, LOAD_TS, by_email=True)
    return store.read(mart.FACT)


@query
def customer_history(spark, sf_dir):
    """The type-2 table of customers after two loads of silver."""
    feed, store = staged_silver(spark, sf_dir), new_store(spark)
    for batch in (before(feed, HISTORY_END), feed):
        # Written out: the delta join and the ordered write read a batch several times.
        mart.append_new(store, mart.SILVER, staged(delta.dedup_batch(batch), "unique"))
        mart.refresh_history(store)
    return store.read(mart.CUSTOMER_HISTORY)


# --- reports


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly spend from a published star."""
    store = new_store(spark)
    store.append(mart.SILVER, silver(spark, sf_dir))
    mart.load(store, LOAD_TS)
    published = store.at()
    return reports.monthly_spend(
        *[published.read(t) for t in (mart.FACT, dims.CUSTOMER.table, dims.DATE.table)]
    )


@query
def monthly_spend(spark, sf_dir):
    return spend(spark, sf_dir)


@query
def top_spenders(spark, sf_dir):
    return reports.top_spenders(spend(spark, sf_dir), TOP)


@query
def daily_totals(spark, sf_dir):
    return reports.daily_totals(silver(spark, sf_dir))


@query
def daily_totals_incremental(spark, sf_dir):
    """Totals of the history, brought up to date by what the whole feed adds, then by
    nothing."""
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    for batch in (before(feed, HISTORY_END), feed, feed):
        mart.append_new(store, mart.SILVER, batch)
        mart.refresh_totals(store)
    return reports.totals_of(store.read(mart.DAY_PARTS))


@query
def table_counts(spark, sf_dir):
    """Rows of the published star, counted in its tables."""
    store = new_store(spark)
    store.append(mart.SILVER, silver(spark, sf_dir))
    mart.load(store, LOAD_TS)
    star = [*(d.table for d in dims.DIMENSIONS), mart.FACT]
    return reports.table_counts({name: store.read(name) for name in star})


# --- incremental warehouse


@query
def raw_incremental(spark, sf_dir):
    feed = staged(transactions(spark, sf_dir), "feed")
    store = new_store(spark)
    mart.ingest_frame(store, before(feed, HISTORY_END))
    mart.raw_incremental(store, feed)
    return store.read(mart.RAW)


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[MartStore, list[mart.StepResult]]:
    """A mart loaded with the first month, then with the whole feed, then with no news."""
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    results = []
    for batch in (before(feed, FIRST_MONTH_END), feed, feed):
        mart.append_new(store, mart.SILVER, batch)
        results.append(mart.load_incremental(store, LOAD_TS))
    return store, results


@query
def reload_or_append(spark, sf_dir):
    """What each load did: all into an empty mart, then only what is new, then nothing."""
    _, results = two_loads(spark, sf_dir)
    rows = [(n, r.status, r.rows) for n, r in enumerate(results, 1)]
    return spark.createDataFrame(rows, "load int, status string, row_count long")


@query
def fact_incremental(spark, sf_dir):
    store, _ = two_loads(spark, sf_dir)
    return store.read(mart.FACT)


def extended(dimension: dims.Dimension, spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = staged_silver(spark, sf_dir)
    known = staged(dimension.build(before(feed, FIRST_MONTH_END)), dimension.table)
    return known.unionByName(dimension.additions(feed, known))


@query
def dim_customer_incremental(spark, sf_dir):
    return extended(dims.CUSTOMER, spark, sf_dir)


@query
def dim_merchant_incremental(spark, sf_dir):
    return extended(dims.MERCHANT, spark, sf_dir)


@query
def dim_date_incremental(spark, sf_dir):
    return extended(dims.DATE, spark, sf_dir)


@query
def fk_orphans(spark, sf_dir):
    """The whole fact against dimensions that only know the first month."""
    feed = staged_silver(spark, sf_dir)
    fact = staged(facts.fact_transactions(feed, *star(feed), LOAD_TS), "fact")
    old = star(before(feed, FIRST_MONTH_END))
    return quality.fk_orphans(fact, {d.id_col: o for d, o in zip(dims.DIMENSIONS, old)})


# --- validation


@query
def schema_check(spark, sf_dir):
    """An untyped delivery without its amounts' column name, against the fixed schema."""
    delivered = text_transactions(spark, sf_dir).withColumnRenamed("customer_email", "email")
    return quality.schema_check(delivered, TRANSACTION)


@query
def csv_bad_rows(spark, sf_dir):
    path = scratch_path(spark, "csv")
    # A letter that is one byte here is none in UTF-8.
    name = F.translate("customer_name", "\ufffd", "\u00e9")
    lines = text_transactions(spark, sf_dir).withColumn("customer_name", name)
    files.write_csv(lines, path, encoding="ISO-8859-1")
    # Written out whole first: a scan of few columns would only parse, and judge, those.
    scanned = staged(files.csv_scan(spark, path, check_bytes=True), "csv-rows")
    verdicts = quality.csv_verdict(scanned).groupBy("verdict")
    return verdicts.agg(F.count(F.lit(1)).alias("row_count"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.transaction_rules(*RULE_DAYS)
    return quality.tag_violations(
        staged(cleaning.clean(text_transactions(spark, sf_dir)), "to-check"), rules
    )


@query
def rule_violations(spark, sf_dir):
    _, quarantined = quality.split_by_rules(tagged(spark, sf_dir))
    return quarantined.withColumn("violations", F.concat_ws(",", "violations"))


@query
def rule_summary(spark, sf_dir):
    names = [*quality.transaction_rules(*RULE_DAYS), "id_unique"]
    return quality.rule_summary(tagged(spark, sf_dir), names)


# --- history, changes, publishing


def priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's order priority as an attribute that changes with each order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("changed_on"),
        F.col("o_orderkey").alias("seq"),
    )


@query
def dim_upsert(spark, sf_dir):
    """The customers of the history, then the later changes."""
    changes = priorities(spark, sf_dir)
    order = ["changed_on", "seq"]
    dim = changes.where(F.lit(False))
    for batch in (before(changes, HISTORY_END, "changed_on"), changes):
        dim = history.dim_upsert(dim, batch, "customer_key", order)
    return dim


@query
def scd2_customer(spark, sf_dir):
    """Versions from the history's changes, then from all changes delivered again, on top of
    customers whose old version had ended: some before any change, some between two."""
    changes = priorities(spark, sf_dir)
    old = F.col("c_custkey") % 5
    dim = (
        table(spark, sf_dir, "customer")
        .where(old < 2)
        .select(
            F.col("c_custkey").alias("customer_key"),
            F.lit(OLD_PRIORITY).alias("priority"),
            F.lit(OLD_START).cast("date").alias("valid_from"),
            F.when(old == 0, F.lit(OLD_ENDS[0])).otherwise(F.lit(OLD_ENDS[1])).cast("date").alias("valid_to"),
            F.lit(False).alias("is_current"),
        )
    )
    for batch in (before(changes, HISTORY_END, "changed_on"), changes):
        dim = history.scd2_merge(dim, batch, "customer_key", "priority", "changed_on", "seq")
    return dim


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes to their customer: an open one updates the balance, a pending one
    deletes the customer, a filled one (re)inserts it. Some write the operation in small
    letters, some leave it out or ask for something unknown, some have no customer."""
    ops = {"O": "U", "P": "D", "F": "I"}
    status, order = F.col("o_orderstatus"), F.col("o_orderkey")
    op = F.coalesce(*[F.when(status == s, F.lit(o)) for s, o in ops.items()])
    return table(spark, sf_dir, "orders").select(
        F.when(order % 11 != 3, F.col("o_custkey")).alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.when(order % 7 == 1, F.lower(op))
        .when(order % 7 == 2, F.lit("X"))
        .when(order % 7 != 3, op)
        .alias("op"),
        order.alias("seq"),
    )


@query
def cdc_apply(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    changes = order_changes(spark, sf_dir)
    once = staged(history.cdc_apply(customers, changes, "c_custkey", "op", "seq"), "changed")
    # Delivered again, the same changes leave everything as it is.
    return history.cdc_apply(once, changes, "c_custkey", "op", "seq")


@query
def cdc_rejected(spark, sf_dir):
    return history.cdc_rejected(order_changes(spark, sf_dir), "op")


class Interrupted(RuntimeError):
    """A load stopped on purpose."""


@query
def atomic_publish(spark, sf_dir):
    """The fact readers see after a second load has died before its last step."""
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    store.append(mart.SILVER, before(feed, HISTORY_END))
    mart.load(store, LOAD_TS)
    mart.append_new(store, mart.SILVER, feed)

    def die(written: str) -> None:
        if written == mart.FACT:
            raise Interrupted(written)

    try:
        mart.load(store, LOAD_TS, after_write=die)
    except Interrupted:
        pass
    return store.read(mart.FACT)


@query
def load_audit(spark, sf_dir):
    store = new_store(spark)
    store.append(mart.SILVER, silver(spark, sf_dir))
    mart.load(store, LOAD_TS)
    return store.load_audit()


@query
def load_balance(spark, sf_dir):
    """Two loads of raw rows into silver, the second one the whole feed: what became of them."""
    feed, store = staged(transactions(spark, sf_dir), "feed"), new_store(spark)
    for part in (before(feed, HISTORY_END), feed):
        mart.ingest_frame(store, part)
        mart.transform(store, mart.Checks(dedup=True))
    return store.load_balance()


@query
def read_snapshot(spark, sf_dir):
    """The first version of a table that was appended to and replaced since."""
    feed = staged_silver(spark, sf_dir)
    store = new_store(spark)
    first = store.append(mart.SILVER, before(feed, HISTORY_END))
    store.append(mart.SILVER, delta.new_rows(feed, store.read(mart.SILVER)))
    store.publish({mart.SILVER: delta.dedup_batch(feed)})
    return store.read(mart.SILVER, first)


# --- account star


def account_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.format_string("AC%09d", "c_custkey").alias("account_no"),
        F.col("c_mktsegment").alias("account_type"),
        F.col("c_acctbal").alias("balance"),
    )


def account_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(ID),
        F.format_string("AC%09d", "o_custkey").alias("account_no"),
        F.col("o_orderdate").cast("date").alias("full_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("transaction_type"),
    )


@query
def account_dim(spark, sf_dir):
    dim = accounts.account_dim(account_rows(spark, sf_dir))
    return dim.withColumn("balance", F.col("balance").cast("double"))


@query
def calendar_dim(spark, sf_dir):
    return accounts.calendar_dim(account_transactions(spark, sf_dir))


@query
def account_fact(spark, sf_dir):
    rows = account_transactions(spark, sf_dir)
    fact = accounts.account_fact(
        rows, accounts.account_dim(account_rows(spark, sf_dir)), accounts.calendar_dim(rows)
    )
    return fact.withColumn("amount", F.col("amount").cast("double"))


@query
def account_star(spark, sf_dir):
    """The account star from CSV, its accounts and transactions delivered twice in one feed."""
    folder, store = scratch_path(spark, "account-csv"), new_store(spark)
    rows = account_transactions(spark, sf_dir)
    for part in (1, 2):
        files.write_csv(account_rows(spark, sf_dir), f"{folder}/accounts/{part}")
        files.write_csv(rows.select(*reversed(rows.columns)) if part == 2 else rows, f"{folder}/rows/{part}")
    mart.load_accounts(store, f"{folder}/accounts/*", f"{folder}/rows/*").require()
    return store.read(mart.ACCOUNT_FACT).withColumn("amount", F.col("amount").cast("double"))


# --- streaming


@query
def stream_ingest(spark, sf_dir):
    """Orders as CSV files, part of them delivered a second time, in two micro-batches."""
    feed = staged(order_transactions(spark, sf_dir), "stream-feed")
    folder, store = scratch_path(spark, "stream-in"), new_store(spark)
    checkpoint = scratch_path(spark, "stream-state")
    for part, delivered in enumerate((before(feed, HISTORY_END), feed)):
        files.write_csv(delivered, f"{folder}/delivery-{part}", compression=STREAMED)
        stream = stream_ingest_jobs.csv_stream(spark, f"{folder}/*")
        stream_ingest_jobs.ingest_available(store, mart.SILVER, stream, checkpoint)
    return store.read(mart.SILVER)


@query
def stream_ingest_lines(spark, sf_dir):
    """Line items, whose ids repeat inside and across micro-batches, as two deliveries."""
    feed = staged(transactions(spark, sf_dir), "stream-feed")
    folder, store = scratch_path(spark, "stream-in"), new_store(spark)
    checkpoint = scratch_path(spark, "stream-state")
    for part, delivered in enumerate((before(feed, HISTORY_END), feed)):
        files.write_csv(delivered, f"{folder}/delivery-{part}", compression=STREAMED)
        stream = stream_ingest_jobs.csv_stream(spark, f"{folder}/*")
        stream_ingest_jobs.ingest_available(store, mart.SILVER, stream, checkpoint)
    return store.read(mart.SILVER)


@query
def stream_totals_late(spark, sf_dir):
    """Events of even minutes, then those of odd ones: most come after their day was final."""
    events, folder = table(spark, sf_dir, "events"), scratch_path(spark, "stream-events")
    store, checkpoint = new_store(spark), scratch_path(spark, "stream-state")
    for part in (0, 1):
        events.where(F.minute("ts") % 2 == part).write.parquet(f"{folder}/delivery-{part}")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/*")
        stream = stream.withColumn("ts", stream_totals.utc_instant(F.col("ts")))
        stream_totals.total_available(store, stream, "1 hour", checkpoint)
    return store.read(stream_totals.STREAM_DAYS).drop("newest")


@query
def stream_daily_totals(spark, sf_dir):
    # A pattern, since a stream reads folders or patterns, not a single file.
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    events = events.withColumn("ts", stream_totals.utc_instant(F.col("ts")))
    out = scratch_path(spark, "stream-totals")
    totals = stream_totals.daily_totals_stream(events, "1 hour")
    stream_totals.write_available(totals, out, scratch_path(spark, "stream-state"))
    return spark.read.schema(totals.schema).parquet(out)
