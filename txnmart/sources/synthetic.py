"""Deterministic synthetic transactions from integer arithmetic on the row id.

Every value is a function of (id, seed), so rows are made where they are needed, in any
number of tasks, and a recomputed task makes the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime modulus, two multipliers; amounts in cents, 5.00 to 5000.00.
MODULUS = 2147483647
MULTIPLIER = 48271
HIGH_MULTIPLIER = 69621
ROUNDS = 3
MIN_CENTS = 500
MAX_CENTS = 500000


def _draw(row_id: Column, seed: int, stream: int) -> Column:
    """A number in [0, MODULUS) for one stream of draws; never overflows a long.

    Both halves of a 64-bit id take part, and squaring between the affine steps makes the
    streams independent of each other: affine steps alone would leave all of them functions
    of one number."""
    modulus = F.lit(MODULUS).cast("long")
    low = row_id % modulus
    high = F.call_function("div", row_id - low, modulus) % modulus
    x = (low * MULTIPLIER + high * HIGH_MULTIPLIER + (seed * 1009 + stream * 7919 + 1)) % modulus
    for _ in range(ROUNDS):
        x = ((x * x) % modulus * MULTIPLIER + (stream * 104729 + seed + 1)) % modulus
    return x


def synthetic_transactions(
    ids: DataFrame, customers: int, merchants: int, start: dt.date, end: dt.date, seed: int = 0
) -> DataFrame:
    """One transaction per ``transaction_id`` of ``ids``: uniform amounts, dates from
    ``start`` to ``end``, names and emails numbered below the given population sizes."""
    i = F.col("transaction_id")
    customer = _draw(i, seed, 1) % F.lit(customers)
    merchant = _draw(i, seed, 2) % F.lit(merchants)
    cents = MIN_CENTS + _draw(i, seed, 3) % F.lit(MAX_CENTS - MIN_CENTS + 1)
    day = _draw(i, seed, 4) % F.lit((end - start).days + 1)
    return ids.select(
        i,
        F.format_string("Customer %d", customer).alias("customer_name"),
        F.format_string("customer%d@example.com", customer).alias("customer_email"),
        F.format_string("Merchant %d, Inc", merchant).alias("merchant_name"),
        (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)"))
        .cast("decimal(18,2)")
        .cast("double")
        .alias("transaction_amount"),
        F.date_add(F.lit(start), day.cast("int")).alias("transaction_date"),
    )


def sequential_ids(spark: SparkSession, rows: int) -> DataFrame:
    """Ids 0 .. rows-1."""
    return spark.range(rows).select(F.col("id").alias("transaction_id"))
