"""The synthetic source."""

import datetime as dt

from pyspark.sql import functions as F

from txnmart.sources.synthetic import sequential_ids, synthetic_transactions

START, END = dt.date(2024, 1, 1), dt.date(2024, 12, 31)


def made(spark, seed=1):
    return synthetic_transactions(sequential_ids(spark, 20_000), 300, 40, START, END, seed)


def test_ranges_and_populations(spark):
    row = made(spark).agg(
        F.count("*").alias("n"),
        F.count_distinct("transaction_id").alias("ids"),
        F.min("transaction_amount").alias("low"),
        F.max("transaction_amount").alias("high"),
        F.avg("transaction_amount").alias("mean"),
        F.min("transaction_date").alias("first"),
        F.max("transaction_date").alias("last"),
        F.count_distinct("customer_email").alias("customers"),
        F.count_distinct("merchant_name").alias("merchants"),
        F.max(F.abs(F.col("transaction_amount") * 100 - F.round(F.col("transaction_amount") * 100))).alias("dust"),
    ).first()
    assert (row.n, row.ids, row.customers, row.merchants) == (20_000, 20_000, 300, 40)
    assert 5 <= row.low < 15 and 4990 < row.high <= 5000 and 2400 < row.mean < 2600
    assert (row["first"], row["last"]) == (START, END)
    assert row.dust < 1e-6


def test_same_seed_same_rows_however_partitioned(spark):
    assert made(spark).repartition(7).exceptAll(made(spark)).count() == 0
    assert made(spark, 2).join(made(spark), ["transaction_id", "transaction_amount"]).count() < 200


def test_columns_are_independent(spark):
    """A customer with many rows meets nearly as many merchants, days and amounts."""
    rows = synthetic_transactions(sequential_ids(spark, 40_000), 4_000, 400, START, END, 3)
    per_customer = rows.groupBy("customer_email").agg(
        F.count("*").alias("n"),
        F.count_distinct("merchant_name").alias("merchants"),
        F.count_distinct("transaction_date").alias("days"),
        F.count_distinct("transaction_amount").alias("amounts"),
    )
    sums = per_customer.agg(*[F.sum(c) for c in ("n", "merchants", "days", "amounts")]).first()
    assert min(sums[1:]) > 0.97 * sums[0]
    codes = rows.select(
        F.regexp_extract("customer_name", r"(\d+)", 1).cast("int").alias("c"),
        F.regexp_extract("merchant_name", r"(\d+)", 1).cast("int").alias("m"),
        F.col("transaction_amount").alias("a"),
        F.dayofyear("transaction_date").alias("d"),
        F.col("transaction_id").alias("i"),
    )
    for x, y in [("c", "m"), ("c", "a"), ("c", "d"), ("m", "a"), ("m", "d"), ("a", "d"), ("i", "c"), ("i", "a")]:
        assert abs(codes.stat.corr(x, y)) < 0.02


def test_values_do_not_repeat_after_the_modulus(spark):
    ids = spark.createDataFrame([(i + k * 2147483647,) for i in range(200) for k in range(2)], "transaction_id long")
    made = synthetic_transactions(ids, 10**6, 10**6, START, END).collect()
    assert len({r.customer_name for r in made}) > 390
