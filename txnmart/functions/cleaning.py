"""Casting, standardising, defaulting and enriching transactions; all stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.schemas import MONEY, TRANSACTION

TEXT = ["customer_name", "customer_email", "merchant_name"]
UPPERCASED = ["customer_name", "merchant_name"]
# NULL ids, names and emails stay NULL: only a label with no identity gets a default.
DEFAULTS = {"merchant_name": "UNKNOWN"}


def cast_project(df: DataFrame) -> DataFrame:
    """The six typed columns; a value that does not parse becomes NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TRANSACTION.fields]
    )


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim all text, upper-case names and merchants; email case is kept."""

    def cleaned(name: str) -> Column:
        trimmed = F.trim(F.col(name))
        return F.upper(trimmed) if name in UPPERCASED else trimmed

    return df.withColumns({name: cleaned(name) for name in TEXT})


def clean(df: DataFrame) -> DataFrame:
    """Raw rows to the typed, standardised form every later step works on."""
    return clean_strings(cast_project(df))


def null_handling(df: DataFrame, defaults: Mapping[str, str] = DEFAULTS) -> DataFrame:
    """Blank text to NULL, then a default where the column has one."""
    blank_to_null = {c: F.nullif(F.col(c), F.lit("")) for c in TEXT}
    return df.withColumns(
        {
            c: F.coalesce(value, F.lit(defaults[c])) if c in defaults else value
            for c, value in blank_to_null.items()
        }
    )


def enrich_tax_discount(
    df: DataFrame, amount: str = "transaction_amount", discount: str = "discount", tax: str = "tax"
) -> DataFrame:
    """Add ``net_amount`` and ``gross_amount``: exact decimals, half-up to cents."""
    rate = "decimal(5,4)"
    net = F.round(F.col(amount).cast(MONEY) * (1 - F.col(discount).cast(rate)), 2).cast(MONEY)
    gross = F.round(F.col("net_amount") * (1 + F.col(tax).cast(rate)), 2).cast(MONEY)
    return df.withColumn("net_amount", net).withColumn("gross_amount", gross)


def date_parts(df: DataFrame, date: str = "transaction_date", quarter: bool = False) -> DataFrame:
    """Calendar columns; ``weekday`` counts from Sunday = 1."""
    d = F.col(date)
    parts = {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "weekday": F.dayofweek(d),
    }
    if quarter:
        parts["quarter"] = F.quarter(d)
    return df.withColumns(parts)


def with_load_timestamp(df: DataFrame, load_ts: str) -> DataFrame:
    """Stamp the batch; the time is a parameter so that a rerun gives the same rows."""
    return df.withColumn("load_timestamp", F.lit(load_ts).cast("timestamp_ntz"))
