"""The daily jobs: ingest, transform, load. Each publishes to the mart or changes nothing."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from txnmart.functions.cleaning import clean, null_handling
from txnmart.operators import accounts, reports
from txnmart.operators.delta import Fresh, dedup_batch, find_new, new_rows
from txnmart.operators.dims import DIMENSIONS, Dimension
from txnmart.operators.facts import fact_transactions
from txnmart.operators.history import scd2_changes, scd2_merge
from txnmart.operators.quality import split_by_rules, tag_violations, transaction_rules
from txnmart.schemas import ACCOUNT, ACCOUNT_TRANSACTION, COLUMNS, ID
from txnmart.scratch import staged
from txnmart.sinks.jdbc import JdbcTarget, append, check_rows, is_empty, reload_all, without_secrets
from txnmart.sinks.store import APPEND, UPSERT, MartStore, Snapshot, Written
from txnmart.sources.files import csv_scan, path_exists

RAW, SILVER, QUARANTINE, FACT = "raw", "silver", "silver_quarantine", "fact_transactions"
DAY_PARTS, CUSTOMER_HISTORY = "day_parts", "customer_history"
DATABASE_LOADS = "database_loads"
ACCOUNT_DIM, CALENDAR_DIM, ACCOUNT_FACT = "account_dim", "calendar_dim", "account_fact"
MOST_UPSERTS = 16
# How commits are named: silver rows that were compared with silver, and how a fact's
# customers were found.
CHECKED_NEW, BY_EMAIL, BY_NAME = "new:", "load-by-email:", "load-by-name:"

LOADED = "LOADED"
UNCHANGED = "UNCHANGED"
SKIPPED_NO_SOURCE = "SKIPPED_NO_SOURCE"
SKIPPED_EMPTY = "SKIPPED_EMPTY"


class RowsLost(RuntimeError):
    """Rows that a job took in and that are neither in what it wrote nor counted as known, rejected
    or repeated. Nothing is published then."""


class StepSkipped(RuntimeError):
    """Raised by :meth:`StepResult.require` for a step that had nothing to work on."""


@dataclass(frozen=True)
class StepResult:
    """What a job did. Skipping is a result, not an error: the caller decides."""

    status: str
    rows: int = 0
    version: int | None = None

    def require(self) -> StepResult:
        if self.status.startswith("SKIPPED"):
            raise StepSkipped(self.status)
        return self


def ingest(store: MartStore, csv_path: str) -> StepResult:
    """CSV to the raw table, replacing it: one scan, counted while it is written."""
    present = path_exists(store.spark, csv_path)
    return ingest_frame(store, csv_scan(store.spark, csv_path) if present else None)


def ingest_frame(store: MartStore, feed: DataFrame | None) -> StepResult:
    if feed is None:
        return StepResult(SKIPPED_NO_SOURCE)
    raw = store.write(RAW, feed)
    if raw.rows == 0:
        return StepResult(SKIPPED_EMPTY)
    return StepResult(LOADED, raw.rows, store.commit(raw))


def ingest_incremental(store: MartStore, csv_path: str) -> StepResult:
    """CSV to the raw table, adding only rows whose id it lacks; parsed once."""
    if not path_exists(store.spark, csv_path):
        return StepResult(SKIPPED_NO_SOURCE)
    return raw_incremental(store, staged(csv_scan(store.spark, csv_path), "feed"))


def raw_incremental(store: MartStore, feed: DataFrame | None) -> StepResult:
    """Append to the raw table only the rows whose id it lacks."""
    return append_new(store, RAW, feed)


@dataclass(frozen=True)
class Checks:
    """What a validated transform does beyond cleaning; each part is optional.

    ``defaults``: blank text becomes NULL and gets its default. ``dedup``: one row per id.
    ``days``: the first and last day a transaction may have; with it all business rules
    (:func:`transaction_rules`, and ids that do not repeat) must hold."""

    defaults: bool = False
    dedup: bool = False
    days: tuple[str, str] | None = None


def transform(store: MartStore, checks: Checks = Checks()) -> StepResult:
    """Clean the raw table, apply ``checks``, and append what is new to silver.

    Without checks all rows with an id go on, as they are. Rows without an id would be new
    on every run; they, and those that break a rule, are added to the quarantine table with
    the rules they break, once however often they are delivered.
    """
    mart = store.at()
    raw = mart.read(RAW)
    if raw is None:
        return StepResult(SKIPPED_NO_SOURCE)
    cleaned = clean(raw.select(COLUMNS))
    rows = left = mart.rows(RAW)
    if checks.defaults:
        cleaned = null_handling(cleaned)
    if checks.dedup:
        cleaned, left = _counted(dedup_batch(cleaned), "deduplicated")
    if checks.days:
        rules = transaction_rules(*checks.days)
        # What was de-duplicated has been written already.
        to_check = cleaned if checks.dedup else staged(cleaned, "to-check")
        tagged = staged(tag_violations(to_check, rules), "checked")
        good, bad = split_by_rules(tagged)
        bad, rejected = _counted(bad.withColumn("violations", F.concat_ws(",", "violations")), "rejected")
    else:
        good, bad = cleaned.where(F.col(ID).isNotNull()), without_ids(cleaned)
        rejected = raw.where(F.col(ID).isNull()).count()
    delta, known = _write_new(store, mart, SILVER, good)
    lost = write_rejected(store, mart, bad) if rejected else []
    balance = {"rows": rows, "repeated": rows - left, "rejected": rejected, "known": known, "new": delta.rows}
    return _commit_new(store, mart, delta, lost, balance)


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A staged frame and its rows, counted by the write."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return out, seen.get["rows"]


def without_ids(rows: DataFrame) -> DataFrame:
    """The rows without an id, as the quarantine holds them."""
    return rows.where(F.col(ID).isNull()).withColumn("violations", F.lit("id_present"))


def write_rejected(
    store: MartStore, mart: Snapshot, rows: DataFrame, table: str = QUARANTINE
) -> list[Written]:
    """Write what the quarantine does not hold yet: as many copies of a row as are missing.

    What it holds is told by a table beside it with two hashes of each content and its copies, in the
    order of the first: a delivery reads the files of it that can hold the hashes it brings, and no
    rejected rows. A quarantine from before that table is hashed once."""
    hashes = f"{table}_contents"
    columns = rows.columns
    counted = staged(_contents(rows, columns), "rejected-contents")
    known = mart.near(hashes, counted.select("content"), "content") if mart.read(hashes) is not None else None
    added = counted
    older = mart.read(table) if known is None and mart.read(hashes) is None else None
    if older is not None:
        known = staged(_contents(older, columns), "quarantine-contents")
    if known is not None:
        held = known.groupBy("content", "check").agg(F.sum("copies").alias("held"))
        left = F.col("copies") - F.coalesce("held", F.lit(0))
        added = counted.join(held, ["content", "check"], "left").withColumn("copies", left).where("copies > 0")
    added = staged(added.select("content", "check", "copies"), "new-contents")
    # One row of each content, as often as copies are missing: equal rows need not be moved.
    one = _hashed(rows, columns).dropDuplicates(["content", "check"]).join(added, ["content", "check"])
    again = one.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    written = store.write(table, again.select(columns), APPEND)
    if not written.rows:
        return []
    if older is not None:
        added = added.unionByName(known)
    return [written, store.write(hashes, added, APPEND, order="content")]


def _hashed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with two hashes of all they hold, NULLs and their places included."""
    whole = F.to_json(F.struct(*columns))
    return rows.withColumn("content", F.xxhash64(whole)).withColumn("check", F.xxhash64(F.lit(1), whole))


def _contents(rows: DataFrame, columns: list[str]) -> DataFrame:
    copies = F.count(F.lit(1)).alias("copies")
    return _hashed(rows.select(columns), columns).groupBy("content", "check").agg(copies)


def append_new(store: MartStore, table: str, batch: DataFrame | None) -> StepResult:
    """Append the rows of a batch whose id the table lacks; all of them to an empty or
    missing table. With none, the table and its version stay as they are."""
    if batch is None:
        return StepResult(SKIPPED_NO_SOURCE)
    mart = store.at()
    delta, _ = _write_new(store, mart, table, batch)
    return _commit_new(store, mart, delta)


def _write_new(store: MartStore, mart: Snapshot, table: str, batch: DataFrame) -> tuple[Written, int]:
    """The new rows, in the order of their ids, and how many of the batch the table has."""
    fresh = Fresh(batch, 0)
    if mart.rows(table) > 0:
        fresh = find_new(batch, lambda keys: mart.near(table, keys, ID))
    return store.write(table, fresh.rows, APPEND, order=ID), fresh.known


def _commit_new(
    store: MartStore,
    mart: Snapshot,
    delta: Written,
    aside: list[Written] = [],  # noqa: B006
    balance: dict[str, int] | None = None,
) -> StepResult:
    if balance and balance["rows"] != sum(n for k, n in balance.items() if k != "rows"):
        raise RowsLost(f"{delta.table}: {balance}")
    tables = [w for w in (delta, *aside) if w.rows]
    name = f"{CHECKED_NEW}{uuid.uuid4().hex}"
    version = store.commit(*tables, base=mart.version, name=name, balance=balance) if tables else None
    if delta.rows:
        return StepResult(LOADED, delta.rows, version)
    return StepResult(SKIPPED_EMPTY if mart.read(delta.table) is None else UNCHANGED)


def load(
    store: MartStore,
    load_ts: str,
    by_email: bool = False,
    after_write: Callable[[str], None] | None = None,
) -> StepResult:
    """Rebuild the three dimensions and the fact, and publish all four as one version.

    Dimensions are written once and read back for the fact. ``after_write`` is called
    with each table's name once it is written; whatever it raises stops the load, and
    readers keep the version before.
    """
    mart = store.at()
    silver = mart.read(SILVER)
    if silver is None:
        return StepResult(SKIPPED_NO_SOURCE)
    if mart.rows(SILVER) == 0:
        return StepResult(SKIPPED_EMPTY)
    done = after_write or (lambda table: None)

    def build(dimension: Dimension) -> Written:
        written = store.write(dimension.table, dimension.build(silver))
        done(dimension.table)
        return written

    dims = _for_each_dimension(build)
    star = [store.written(w) for w in dims]
    fact = store.write(FACT, fact_transactions(silver, *star, load_ts, by_email=by_email))
    done(FACT)
    name = f"{BY_EMAIL if by_email else BY_NAME}{uuid.uuid4().hex}"
    return StepResult(LOADED, fact.rows, store.commit(*dims, fact, base=mart.version, name=name))


def load_incremental(store: MartStore, load_ts: str, by_email: bool = False) -> StepResult:
    """Extend the published star by the silver rows its fact lacks.

    Only silver rows added after the version the fact was computed from are looked at. They
    are new to the fact if the jobs here added them, which compare ids with silver; only if
    silver was replaced or written by other means are they compared with the fact's ids.
    Known members keep their ids; new ones are numbered on from the last. Customers are found
    as the fact's full load found them; with no fact yet, or an empty one, this is a full
    :func:`load`, and ``by_email`` says how.
    """
    mart = store.at()
    if mart.read(SILVER) is None:
        return StepResult(SKIPPED_NO_SOURCE)
    if mart.rows(FACT) == 0:
        return load(store, load_ts, by_email)
    by_email = mart.commits(FACT)[0].startswith(BY_EMAIL)
    since = mart.base(FACT)
    batch = mart.read(SILVER, since=since)
    if batch is None:
        return StepResult(UNCHANGED)
    checked = all(c.startswith(CHECKED_NEW) for c in mart.commits(SILVER, since=since))
    if mart.replaced_since(SILVER, since) or not checked:
        batch = staged(new_rows(batch, mart.read(FACT)), "unloaded")
    if batch.isEmpty():
        return StepResult(UNCHANGED)

    def extend(dimension: Dimension) -> Written:
        additions = dimension.additions(batch, mart.read(dimension.table))
        return store.write(dimension.table, additions, APPEND)

    added = _for_each_dimension(extend)
    star = [mart.read(w.table).unionByName(store.written(w)) for w in added]
    delta = store.write(
        FACT, fact_transactions(batch, *star, load_ts, by_email=by_email), APPEND
    )
    tables = [*(w for w in added if w.rows), delta]
    return StepResult(LOADED, delta.rows, store.commit(*tables, base=mart.version))


def _for_each_dimension(work: Callable[[Dimension], Written]) -> list[Written]:
    """Run the dimensions' jobs side by side: they share nothing but the cluster."""
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        return list(pool.map(work, DIMENSIONS))


def run(
    store: MartStore,
    csv_path: str,
    load_ts: str,
    checks: Checks = Checks(),
    by_email: bool = False,
) -> StepResult:
    """Ingest, transform and load in turn, as one version: what one of them raises leaves the mart
    as it was. Stops at a step that is skipped, and publishes what came before."""
    together = store.transaction()
    done = ingest(together, csv_path)
    if done.status == LOADED:
        transform(together, checks)
        done = load(together, load_ts, by_email)
    together.publish_all()
    return done


def load_accounts(store: MartStore, accounts_csv: str, transactions_csv: str) -> StepResult:
    """Publish the account star from two CSV feeds as one version. Of rows with one account number, or
    one transaction id, the least counts; an account without a number is in no dimension, a
    transaction of an unknown account or without a day has no id of it."""
    spark = store.spark
    if not (path_exists(spark, accounts_csv) and path_exists(spark, transactions_csv)):
        return StepResult(SKIPPED_NO_SOURCE)
    named = csv_scan(spark, accounts_csv, ACCOUNT).where(F.col("account_no").isNotNull())
    held = staged(dedup_batch(named, "account_no"), "accounts")
    rows, many = _counted(dedup_batch(csv_scan(spark, transactions_csv, ACCOUNT_TRANSACTION)), "account-rows")
    if not many:
        return StepResult(SKIPPED_EMPTY)
    dim = store.write(ACCOUNT_DIM, accounts.account_dim(held))
    days = store.write(CALENDAR_DIM, accounts.calendar_dim(rows.where(F.col("full_date").isNotNull())))
    fact = store.write(ACCOUNT_FACT, accounts.account_fact(rows, store.written(dim), store.written(days)))
    return StepResult(LOADED, fact.rows, store.commit(dim, days, fact))


def refresh_history(store: MartStore) -> StepResult:
    """Keep the type-2 table of customers up to date: the name each email goes by, and since
    when, from the silver rows added since. Of one day's names the last by id counts.

    All versions of the emails that the rows hold are written, in place of the ones before, and
    nothing of the others; the table is written whole again when there are ``MOST_UPSERTS`` such
    parts, or they have half its rows."""
    mart = store.at()
    if mart.read(SILVER) is None:
        return StepResult(SKIPPED_NO_SOURCE)
    known, since = mart.read(CUSTOMER_HISTORY), mart.base(CUSTOMER_HISTORY)
    if mart.replaced_since(SILVER, since):
        known, since = None, 0
    added = mart.read(SILVER, since=since)
    if added is None:
        return StepResult(UNCHANGED)
    if known is None:
        known = store.spark.range(0).selectExpr(
            "cast(null as string) as customer_email", "cast(null as string) as customer_name",
            "cast(null as date) as valid_from", "cast(null as date) as valid_to",
            "cast(null as boolean) as is_current",
        )
    changes = added.where("transaction_date is not null")
    by = ("customer_email", "customer_name", "transaction_date", ID)
    many, rows = mart.upserts(CUSTOMER_HISTORY)
    if not since or many >= MOST_UPSERTS or 2 * rows > mart.rows(CUSTOMER_HISTORY):
        written = store.write(CUSTOMER_HISTORY, scd2_merge(known, changes, *by))
    else:
        changed, _ = scd2_changes(known, changes, *by)
        changed = staged(changed, "changed-history")
        emails = changed.select("customer_email").distinct().withColumnRenamed("customer_email", "_email")
        gone = known.join(emails, F.col("customer_email").eqNullSafe(F.col("_email")), "left_semi").count()
        written = store.write(CUSTOMER_HISTORY, changed, UPSERT, key="customer_email", gone=gone)
    return StepResult(LOADED, written.rows, store.commit(written, base=mart.version))


def refresh_totals(store: MartStore) -> StepResult:
    """Bring the stored per-day parts of the daily totals up to date by the silver rows
    added since; only those are read. Silver that was replaced is read whole."""
    mart = store.at()
    if mart.read(SILVER) is None:
        return StepResult(SKIPPED_NO_SOURCE)
    known, since = mart.read(DAY_PARTS), mart.base(DAY_PARTS)
    if mart.replaced_since(SILVER, since):
        known, since = None, 0
    added = mart.read(SILVER, since=since)
    if added is None:
        return StepResult(UNCHANGED)
    parts = reports.day_parts(added)
    if known is not None:
        parts = reports.add_day_parts(known, parts)
    written = store.write(DAY_PARTS, parts)
    return StepResult(LOADED, written.rows, store.commit(written, base=mart.version))


def load_database(
    store: MartStore, target: JdbcTarget, schema: str, incremental: bool = False
) -> dict[str, int]:
    """Send the published star to the database, dimensions before the fact that points at
    them. Returns the rows sent per table.

    All tables are replaced together (:func:`reload_all`). With ``incremental``, which fits a
    star kept up by :func:`load_incremental`, a table that is empty gets all rows, and another
    one the rows the mart gained since the last load that came to its end, of those the ones
    whose key it lacks. Afterwards the database must hold as many rows as the mart, else
    :class:`LoadMismatch` is raised: ids repeat in the fact, so after a load that died half-way
    an incremental one may find fewer rows than it should, and a full one is needed.
    """
    mart = store.at()
    keys = {**{d.table: d.id_col for d in DIMENSIONS}, FACT: ID}
    names = {table: f"{schema}.{table}" if schema else table for table in keys}
    if not incremental:
        rows = reload_all({names[t]: mart.read(t) for t in keys}, target)
        sent = {t: rows[names[t]] for t in keys}
    else:
        since = last_load(mart, target, schema)
        sent = {}
        for table, key in keys.items():
            if is_empty(store.spark, target, names[table]):
                sent[table] = append(mart.read(table), target, names[table])
                continue
            added = mart.read(table, since=since)
            sent[table] = append(added, target, names[table], key=key) if added is not None else 0
        for table, name in names.items():
            check_rows(store.spark, target, name, mart.rows(table))
    loaded = [(without_secrets(target.url), schema, mart.version)]
    log = store.spark.createDataFrame(loaded, "url string, schema string, version long")
    store.append(DATABASE_LOADS, log.coalesce(1))
    return sent


def last_load(mart: Snapshot, target: JdbcTarget, schema: str) -> int:
    """The version that the last complete load of a database sent; 0 before the first."""
    loads = mart.read(DATABASE_LOADS)
    if loads is None:
        return 0
    same = (F.col("url") == without_secrets(target.url)) & (F.col("schema") == schema)
    return loads.where(same).agg(F.max("version")).first()[0] or 0
