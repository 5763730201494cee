"""The transaction fact: silver rows with the ids of their dimension members.

The joins carry no broadcast hints. Spark broadcasts a dimension whose written size is
under its threshold; a larger one is sort-merge joined, where adaptive execution splits
hot or NULL keys on the transaction side (the dimension side is unique per key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.functions.cleaning import with_load_timestamp
from txnmart.schemas import FACT


def join_customer(df: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Ids by (name, email): a name that is not its email's first one, a NULL name or a
    NULL email finds no id."""
    return df.join(dim_customer, ["customer_name", "customer_email"], "left")


def join_customer_by_email(df: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Ids by email alone, NULL matching NULL, so every row finds its customer."""
    dim = dim_customer.select(F.col("customer_email").alias("dim_email"), "customer_id")
    return df.join(dim, F.col("customer_email").eqNullSafe(F.col("dim_email")), "left")


def join_merchant(df: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    return df.join(dim_merchant, "merchant_name", "left")


def join_date(df: DataFrame, dim_date: DataFrame) -> DataFrame:
    return df.join(dim_date.select("transaction_date", "date_id"), "transaction_date", "left")


def fact_transactions(
    silver: DataFrame,
    dim_customer: DataFrame,
    dim_merchant: DataFrame,
    dim_date: DataFrame,
    load_ts: str,
    by_email: bool = False,
) -> DataFrame:
    """Customers, the dimension least likely to be small, come last: what is shuffled for
    them then carries ids in place of merchant names and dates."""
    customer = join_customer_by_email if by_email else join_customer
    dated = join_date(silver, dim_date).drop("transaction_date")
    joined = customer(join_merchant(dated, dim_merchant).drop("merchant_name"), dim_customer)
    return with_load_timestamp(joined, load_ts).select(FACT.fieldNames())
