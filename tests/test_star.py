"""Keys, dimensions and the fact."""

import datetime as dt

import pytest
from helpers import frame, settings, txn, values
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from txnmart.operators import dims, facts
from txnmart.operators.keys import dense_key

LOAD_TS = "2026-03-12 08:00:00"


@hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.sets(st.one_of(st.none(), st.text(max_size=3)), max_size=20), st.integers(0, 5))
def test_dense_key_is_the_rank(spark, members, start):
    keys = spark.createDataFrame([(m,) for m in members], "k string").repartition(5)
    got = {r.k: r.id for r in dense_key(keys, "k", "id", start).collect()}
    in_order = sorted(members, key=lambda m: (m is not None, (m or "").encode()))
    assert got == {m: start + n for n, m in enumerate(in_order, 1)}


def test_dense_key_over_many_partitions(spark):
    keys = spark.range(20000).selectExpr("(id * 7919) % 20011 as k").repartition(16)
    with settings(
        spark,
        spark__sql__shuffle__partitions="7",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        ranked = dense_key(keys, "k", "id").cache()
    expected = "row_number() over (order by k) as expected"
    assert ranked.selectExpr("k", "id", expected).where("id <> expected").count() == 0
    ranges = ranked.rdd.mapPartitions(lambda rows: [(min(ks), max(ks)) for ks in [[r.k for r in rows]] if ks])
    bounds = sorted(ranges.collect())
    assert len(bounds) > 1 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    ranked.unpersist()


def test_first_name_per_email(spark):
    feed = frame(spark, txn(1, "B"), txn(2, "A"), txn(3, "N", None), txn(4, "M", None), txn(5, None, "z"), txn(6, "Y", "z"))
    assert values(dims.CUSTOMER.build(feed)) == values(
        spark.createDataFrame([("M", None, 1), ("A", "a@x.org", 2), (None, "z", 3)], "a string, b string, c int")
    )


def star(feed):
    return [d.build(feed) for d in dims.DIMENSIONS]


def test_losing_names_and_null_keys_find_no_member(spark):
    feed = frame(
        spark,
        txn(1, "B"),
        txn(2, "A"),
        txn(3, "N", None),
        txn(4, "A", merchant=None),
        txn(5, "A", day=None),
    )
    fact = {r.transaction_id: r for r in facts.fact_transactions(feed, *star(feed), LOAD_TS).collect()}
    assert fact[1].customer_id is None and fact[2].customer_id == 2 and fact[3].customer_id is None
    assert fact[4].merchant_id is None and fact[1].merchant_id == 2
    assert fact[5].date_id is None and fact[1].date_id == 2
    assert fact[1].load_timestamp == dt.datetime(2026, 3, 12, 8)


def test_by_email_every_row_finds_its_customer(spark):
    feed = frame(spark, txn(1, "B"), txn(2, "A"), txn(3, "N", None))
    fact = facts.fact_transactions(feed, *star(feed), LOAD_TS, by_email=True)
    assert {r.transaction_id: r.customer_id for r in fact.collect()} == {1: 2, 2: 2, 3: 1}


def test_additions_keep_known_ids_and_number_on(spark):
    known = dims.CUSTOMER.build(frame(spark, txn(1, "B", "m"), txn(2, "N", None)))
    feed = frame(spark, txn(3, "A", "m"), txn(4, "C", "a"), txn(5, "D", "z"), txn(6, "E", None))
    added = dims.CUSTOMER.additions(feed, known)
    assert values(added) == [("C", "a", 3), ("D", "z", 4)]
    assert dims.CUSTOMER.additions(feed, known.unionByName(added)).count() == 0


def test_additions_to_an_empty_dimension(spark):
    feed = frame(spark, txn(1))
    empty = dims.DATE.build(frame(spark))
    assert values(dims.DATE.additions(feed, empty)) == [(dt.date(2024, 1, 7), 1, 2024, 1, 7, 1)]


def test_ids_beyond_the_range_of_int(spark):
    keys = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    start = 2**31 - 2
    got = dense_key(keys, "k", "id", start=start)
    assert got.schema["id"].dataType.simpleString() == "bigint"
    assert {r.k: r.id for r in got.collect()} == {None: start + 1, "a": start + 2, "b": start + 3}
    small = dense_key(keys, "k", "id", id_type="int")
    assert small.schema["id"].dataType.simpleString() == "int"
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        dense_key(keys, "k", "id", start=start, id_type="int").collect()
