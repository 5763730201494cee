"""The account variant of the star: accounts, calendar with quarters, decimal amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.functions.cleaning import date_parts
from txnmart.operators.keys import dense_key
from txnmart.schemas import MONEY


def account_dim(accounts: DataFrame) -> DataFrame:
    """Accounts (account_no, account_type, balance) with a status and an ``account_id``."""
    rows = accounts.select(
        "account_no",
        "account_type",
        F.col("balance").cast(MONEY).alias("balance"),
        F.when(F.col("balance") < 0, "OVERDRAWN").otherwise("ACTIVE").alias("status"),
    )
    return dense_key(rows, "account_no", "account_id")


def calendar_dim(days: DataFrame) -> DataFrame:
    """Distinct ``full_date`` with year, month, quarter and a ``date_id``."""
    keyed = dense_key(days.select("full_date").distinct(), "full_date", "date_id")
    return date_parts(keyed, "full_date", quarter=True).select(
        "date_id", "full_date", "year", "month", "quarter"
    )


def account_fact(
    transactions: DataFrame, accounts: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Transactions (id, account_no, full_date, amount, type) with account and date ids."""
    return (
        transactions.join(accounts.select("account_no", "account_id"), "account_no", "left")
        .join(calendar.select("full_date", "date_id"), "full_date", "left")
        .select(
            "transaction_id",
            "account_id",
            "date_id",
            F.col("amount").cast(MONEY).alias("amount"),
            "transaction_type",
        )
    )
