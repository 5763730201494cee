"""Reports over the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.schemas import MONEY


def monthly_spend(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Spend by customer name and month of any year.

    The fact shrinks to one row per (customer, month) before customers are joined, so
    what is shuffled for that join no longer grows with the number of transactions.
    """
    amount = F.col("transaction_amount").cast(MONEY)
    per_id = (
        fact.where(F.col("customer_id").isNotNull())
        .join(dim_date.select("date_id", "month"), "date_id")
        .groupBy("customer_id", "month")
        .agg(F.sum(amount).alias("spent"))
    )
    return (
        per_id.join(dim_customer.select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_name", "month")
        .agg(F.sum("spent").cast("double").alias("total_spent"))
    )


def top_spenders(spend: DataFrame, n: int) -> DataFrame:
    """The ``n`` largest monthly totals; ties go by name, then month."""
    return spend.orderBy(F.desc("total_spent"), "customer_name", "month").limit(n)


def day_parts(silver: DataFrame) -> DataFrame:
    """Per day, the numbers totals are made of; parts of a table can be added up later."""
    amount = F.col("transaction_amount").cast(MONEY)
    return silver.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count(amount).alias("amounts"),
        F.sum(amount).cast("decimal(38,2)").alias("total"),
        F.min("transaction_amount").alias("smallest"),
        F.max("transaction_amount").alias("largest"),
    )


def add_day_parts(parts: DataFrame, more: DataFrame) -> DataFrame:
    """The parts of two disjoint sets of rows as those of their union."""
    return (
        parts.unionByName(more)
        .groupBy("transaction_date")
        .agg(
            F.sum("transactions").alias("transactions"),
            F.sum("amounts").alias("amounts"),
            F.sum("total").cast("decimal(38,2)").alias("total"),
            F.min("smallest").alias("smallest"),
            F.max("largest").alias("largest"),
        )
    )


def totals_of(parts: DataFrame) -> DataFrame:
    total = F.col("total").cast("double")
    return parts.select(
        "transaction_date",
        "transactions",
        total.alias("total_amount"),
        F.try_divide(total, F.col("amounts")).alias("average_amount"),
        "smallest",
        "largest",
    )


def daily_totals(silver: DataFrame) -> DataFrame:
    """Count, sum, average, least and largest amount per day, sums exact to the cent."""
    return totals_of(day_parts(silver))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
