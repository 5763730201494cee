"""Daily totals of an event stream, each day published when it is complete.

:func:`daily_totals_stream` lets Spark's watermark drop what comes later. :func:`total_available`
counts it: the state holds a row per day, and a table of the mart says of each day how many events are
in its total and how many came too late, so that every event is in one of the two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.schemas import MONEY
from txnmart.scratch import staged
from txnmart.sinks.store import MartStore

STREAM_DAYS = "stream_days"


def utc_instant(ts: Column) -> Column:
    """The instant at which UTC clocks show a zone-less time, whatever the session's zone:
    watermarks need instants, and windows of a day start at midnight UTC."""
    return F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone())


def utc_day(ts: Column) -> Column:
    """The day of an instant in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def daily_totals_stream(
    events: DataFrame, lateness: str, ts: str = "ts", amount: str = "value"
) -> DataFrame:
    """Per UTC day, events and total amount. A day is final once the newest event is
    ``lateness`` past its end; events later than that are left out."""
    day = F.window(ts, "1 day")
    return (
        events.withWatermark(ts, lateness)
        .groupBy(day)
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum(F.col(amount).cast(MONEY)).alias("total"),
        )
        .select(
            utc_day(F.col("window.start")).alias("day"),
            "transactions",
            F.col("total").cast("double").alias("total_amount"),
        )
    )


def write_available(totals: DataFrame, path: str, checkpoint: str) -> None:
    """Append the days that have become final to parquet, then stop."""
    query = (
        totals.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def total_available(
    store: MartStore,
    events: DataFrame,
    lateness: str,
    checkpoint: str,
    table: str = STREAM_DAYS,
    ts: str = "ts",
    amount: str = "value",
) -> None:
    """Bring a table of days up to date with the events that have arrived, then stop: ``day``,
    ``transactions`` and ``total_amount`` of the events counted, ``late_transactions``, ``final``,
    and ``newest``, the last instant seen of the day.

    As with the watermark, a day is final once the newest event of all is ``lateness`` past its end,
    and an event is late if its day was final before its micro-batch. Events without a time are of a
    day NULL, which is never final. The table has a row per day and is written anew by each
    micro-batch, as one version; a micro-batch that is run again adds nothing."""

    def settle(changed: DataFrame, number: int) -> None:
        stream_id = store.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        mart, name = store.at(), f"{stream_id}/{number}"
        if mart.has(name):
            return
        # Written once: a second look would run the state's update again.
        days = days_after(mart.read(table), staged(changed, "changed-days"), lateness)
        store.commit(store.write(table, days.coalesce(1)), base=mart.version, name=name)

    changed = events.groupBy(utc_day(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("seen"), F.sum(F.col(amount).cast(MONEY)).alias("total"), F.max(ts).alias("newest")
    )
    query = (
        changed.writeStream.outputMode("update")
        .foreachBatch(settle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def days_after(known: DataFrame | None, changed: DataFrame, lateness: str) -> DataFrame:
    """The table of days after some have changed. ``changed``: ``day``, and of all its events ever
    ``seen`` how many, their ``total`` and the ``newest``."""
    if known is None:
        known = changed.select(
            "day", F.lit(0).cast("long").alias("transactions"), F.lit(0.0).alias("total_amount"),
            F.lit(0).cast("long").alias("late_transactions"), F.lit(False).alias("final"), "newest",
        ).limit(0)
    before, now = (df.agg(F.unix_micros(F.max("newest"))).first()[0] for df in (known, changed))
    newest = max((t for t in (before, now) if t is not None), default=None)
    end = F.timestamp_seconds((F.unix_date("day") + 1) * 86400)

    def passed(by: int | None) -> Column:
        """Whether a day was over, and the lateness too, when ``by`` was the newest event."""
        if by is None:
            return F.lit(False)
        return F.coalesce(end <= F.timestamp_micros(F.lit(by)) - F.expr(f"interval {lateness}"), F.lit(False))

    zero = F.lit(0).cast("long")
    old = known.select(*[F.col(c).alias(f"old_{c}") for c in known.columns])
    met = old.join(changed, F.col("old_day").eqNullSafe(F.col("day")), "full")
    met = met.withColumn("day", F.coalesce("day", "old_day"))
    counted, late = (F.coalesce(f"old_{c}", zero) for c in ("transactions", "late_transactions"))
    more = F.coalesce(F.col("seen") - counted - late, zero)
    closed = passed(before)
    total = F.when(closed | F.col("seen").isNull(), F.coalesce("old_total_amount", F.lit(0.0))).otherwise(
        F.coalesce(F.col("total").cast("double"), F.lit(0.0))
    )
    days = met.select(
        "day",
        (counted + F.when(closed, zero).otherwise(more)).alias("transactions"),
        total.alias("total_amount"),
        (late + F.when(closed, more).otherwise(zero)).alias("late_transactions"),
        passed(newest).alias("final"),
        F.greatest("old_newest", "newest").alias("newest"),
    )
    return days.withColumn("final", F.col("final") & (F.col("transactions") > 0))
