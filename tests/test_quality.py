"""Validation operators."""

from helpers import frame, text, txn, values
from pyspark.sql import types as T

from txnmart.operators import dims, facts, quality
from txnmart.schemas import TRANSACTION
from txnmart.scratch import staged
from txnmart.sources.files import csv_scan


def test_each_rule_and_the_split(spark):
    rules = quality.transaction_rules("2024-01-01", "2024-12-31")
    rows = frame(
        spark,
        txn(1),
        txn(None),
        txn(2, amount=0.0),
        txn(3, amount=None),
        txn(4, day="2023-12-31"),
        txn(5, day=None),
        txn(6, email="nobody"),
        txn(7, email=None),
        txn(8),
        txn(8),
        txn(9, email=None, amount=-1.0),
    )
    tagged = quality.tag_violations(rows, rules)
    got = {r.transaction_id: r.violations for r in tagged.collect()}
    assert got == {
        1: [],
        None: ["id_present"],
        2: ["amount_positive"],
        3: ["amount_positive"],
        4: ["date_in_range"],
        5: ["date_in_range"],
        6: ["email_shape"],
        7: ["email_shape"],
        8: ["id_unique"],
        9: ["amount_positive", "email_shape"],
    }
    good, bad = quality.split_by_rules(tagged)
    assert (good.count(), bad.count()) == (1, 10)
    summary = {r.rule: (r.checked, r.broken) for r in quality.rule_summary(tagged, [*rules, "id_unique"]).collect()}
    assert summary == {
        "id_present": (11, 1),
        "amount_positive": (11, 3),
        "date_in_range": (11, 2),
        "email_shape": (11, 3),
        "id_unique": (11, 2),
    }


def test_schema_check(spark):
    rows = spark.createDataFrame([("1", "x"), ("z", None)], "transaction_id string, surplus string")
    expected = T.StructType([TRANSACTION["transaction_id"], TRANSACTION["merchant_name"]])
    assert values(quality.schema_check(rows, expected)) == [
        ("merchant_name", "string", None, "missing", None, None),
        ("surplus", None, "string", "unexpected", 1, None),
        ("transaction_id", "bigint", "string", "type_differs", 0, 1),
    ]


def test_schema_check_of_a_right_table(spark):
    assert {r.status for r in quality.schema_check(frame(spark, txn(1)), TRANSACTION).collect()} == {"ok"}


def test_csv_verdicts(spark, tmp_path):
    path = tmp_path / "feed.csv"
    head = ",".join(TRANSACTION.fieldNames())
    path.write_bytes(
        f"{head}\n1,ann,a@x.org,shop,1.5,2024-01-07\n2,bob,b@x.org,shop,abc,2024-01-07\n"
        "3,eve,e@x.org,shop\n".encode()
        + b"4,j\xff,j@x.org,shop,1.5,2024-01-07\n"
    )
    scanned = staged(csv_scan(spark, str(path)), "verdicts")
    got = {r.transaction_id: r.verdict for r in quality.csv_verdict(scanned).collect()}
    assert got == {1: "good", 2: "malformed", 3: "malformed", 4: "encoding"}


def test_fk_orphans(spark):
    feed = frame(spark, txn(1, "B"), txn(2, "A"), txn(3, "C", "z"), txn(4, "D", "zz"))
    customers, merchants, dates = [d.build(feed) for d in dims.DIMENSIONS]
    fact = facts.fact_transactions(feed, customers, merchants, dates, "2026-01-01 00:00:00")
    report = quality.fk_orphans(
        fact, {"customer_id": customers.where("customer_id < 2"), "date_id": dates}
    )
    assert values(report) == [("customer_id", 2, 1), ("date_id", 0, 0)]


def test_text_columns_of_any_scan(spark):
    rows = text(spark, ("1", "a�", "e", "m", "1", "d")).selectExpr("*", "cast(null as string) as _corrupt_record")
    assert quality.csv_verdict(rows).first().verdict == "encoding"
