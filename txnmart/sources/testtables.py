"""Transaction feeds derived from the supplied test tables.

The feed is dirty on purpose: names and merchants are padded and lower-case, one customer
in ten shares a neighbour's email, one in fifty has none, and transaction ids repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    mailbox = F.when(key % 10 == 1, key - 1).otherwise(key).cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("customer_name"),
        F.when(key % 50 != 7, F.concat(F.lit("user"), mailbox, F.lit("@example.com"))).alias(
            "customer_email"
        ),
    )


def _lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    day = F.col("l_shipdate").cast("date").alias("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(*keys, day, *more)


def _buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's customer. Line items, the largest table, meet this alone, so that they are
    shuffled once and not for orders and for customers."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = _customers(spark, sf_dir)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


def transactions(spark: SparkSession, sf_dir: str, rates: bool = False) -> DataFrame:
    """One raw transaction per line item; ``rates`` adds its discount and tax."""
    lines = _lines(spark, sf_dir, *(["l_discount", "l_tax"] if rates else []))
    merchants = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat(F.lower("s_name"), F.lit(" ")).alias("merchant_name")
    )
    extra = [F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")] if rates else []
    return (
        lines.join(_buyers(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(merchants, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            "customer_name",
            "customer_email",
            "merchant_name",
            F.col("l_extendedprice").alias("transaction_amount"),
            F.col("l_shipdate").alias("transaction_date"),
            *extra,
        )
    )


def text_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as untyped text with defects, picked by the line's quantity: amounts with
    a currency, missing dates, prefixed ids, undecodable names, blank merchants, emails
    and names."""
    quantity = F.col("l_quantity")
    lines = (
        _lines(spark, sf_dir, "l_quantity")
        .join(_buyers(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
            F.col("l_suppkey") == F.col("s_suppkey"),
        )
    )
    number = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    day = F.col("l_shipdate").cast("string")
    name = F.col("customer_name")
    return lines.select(
        F.when(quantity == 3, F.concat(F.lit("TX"), number))
        .otherwise(number)
        .alias("transaction_id"),
        F.when(quantity == 4, F.concat(name, F.lit("\ufffd")))
        .when(quantity == 7, F.lit("   "))
        .otherwise(name)
        .alias("customer_name"),
        F.when(quantity == 6, F.lit(" ")).otherwise(F.col("customer_email")).alias("customer_email"),
        F.when(quantity == 5, F.lit("  "))
        .otherwise(F.concat(F.lower("s_name"), F.lit(", inc ")))
        .alias("merchant_name"),
        F.when(quantity == 1, F.concat(amount, F.lit(" USD")))
        .otherwise(amount)
        .alias("transaction_amount"),
        F.when(quantity == 2, F.lit("n/a")).otherwise(day).alias("transaction_date"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw transaction per order: ids are unique here. The order priority stands in
    for the merchant."""
    orders = table(spark, sf_dir, "orders")
    return orders.join(
        _customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.col("o_orderkey").alias("transaction_id"),
        "customer_name",
        "customer_email",
        F.lower("o_orderpriority").alias("merchant_name"),
        F.col("o_totalprice").alias("transaction_amount"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )


def before(df: DataFrame, cutover: str, date: str = "transaction_date") -> DataFrame:
    """The part of a feed that had arrived when the mart was last loaded."""
    return df.where(F.col(date) < F.lit(cutover).cast("date"))
