"""Which rows of a batch are new."""

import pytest
from helpers import frame, settings, txn, values
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from txnmart.operators.delta import dedup_batch, merged, new_rows
from txnmart.scratch import staged


def ids(df):
    return sorted((r.transaction_id for r in df.collect()), key=str)


def test_only_ids_of_the_existing_table_are_removed(spark):
    batch = frame(spark, txn(1), txn(2), txn(2, name="BOB"), txn(3))
    assert ids(new_rows(batch, frame(spark, txn(1), txn(9)))) == [2, 2, 3]


def test_null_ids_are_new_on_every_run(spark):
    batch = frame(spark, txn(None), txn(1))
    table = merged(frame(spark, txn(1)), batch)
    assert ids(merged(table, batch)) == sorted([1, None, None], key=str)


def test_redelivery_with_few_new_rows(spark):
    batch = frame(spark, *[txn(i) for i in range(20)], txn(20), txn(20), txn(None))
    assert ids(new_rows(batch, frame(spark, *[txn(i) for i in range(20)]))) == [20, 20, None]
    assert ids(new_rows(batch, batch)) == [None]


def test_batch_of_null_ids_only(spark):
    assert ids(new_rows(frame(spark, txn(None), txn(None)), frame(spark, txn(None)))) == [None, None]


def test_empty_sides(spark):
    some, none = frame(spark, txn(1)), frame(spark)
    assert ids(new_rows(some, none)) == [1]
    assert ids(new_rows(none, some)) == []
    assert ids(merged(None, some)) == [1]
    assert ids(merged(some, none)) == [1]


def test_dedup_keeps_the_least_row_with_nulls_first(spark):
    batch = frame(spark, txn(1, name="B"), txn(1, name="A"), txn(2, name="Z"), txn(2, name=None))
    assert values(dedup_batch(batch)) == values(frame(spark, txn(1, name="A"), txn(2, name=None)))


def test_dedup_keeps_every_row_without_an_id(spark):
    batch = frame(spark, txn(None), txn(None), txn(1), txn(1))
    assert ids(dedup_batch(batch)) == sorted([1, None, None], key=str)


keys = st.lists(st.one_of(st.none(), st.integers(-3, 6)), max_size=12)


@hypothesis_settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(existing=keys, batch=keys)
def test_new_rows_against_brute_force(spark, existing, batch):
    got = ids(new_rows(frame(spark, *map(txn, batch)), frame(spark, *map(txn, existing))))
    known = set(existing) - {None}
    assert got == sorted((i for i in batch if i not in known), key=str)


def test_same_result_without_broadcast(spark):
    existing = frame(spark, *[txn(i) for i in range(0, 60, 2)])
    batch = frame(spark, *[txn(i % 50) for i in range(200)], *[txn(None)] * 5)
    expected = ids(new_rows(batch, existing))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        assert ids(new_rows(batch, existing)) == expected
    assert len(expected) == 105


@pytest.mark.parametrize("known", [0, 3, 10, 17, 20])
def test_every_way_of_finding_new_rows_gives_the_same(spark, known):
    """From no key known to all of them: the ways differ by which list of keys is shorter."""
    rows = [txn(i % 20, name=f"N{i}") for i in range(50)] + [txn(None), txn(None)]
    existing = frame(spark, *[txn(i) for i in range(known)], txn(99), txn(None))
    for narrow in ({}, {"spark__sql__autoBroadcastJoinThreshold": "-1"}):
        with settings(spark, **narrow):
            got = values(new_rows(staged(frame(spark, *rows), "batch"), existing))
        expected = [r for r in rows if r[0] is None or r[0] >= known]
        assert got == values(frame(spark, *expected))
