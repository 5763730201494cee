"""Upsert, type-2 history and change apply against brute force."""

import datetime as dt

from helpers import values
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from txnmart.operators import history
from txnmart.scratch import staged

DIM = "k long, v string, valid_from date, valid_to date, is_current boolean"
CHANGES = "k long, v string, on date, seq long"
fixture = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def brute(changes):
    """Versions of every key from all its changes."""
    out = []
    for k in {c[0] for c in changes}:
        last = {}
        for _, v, on, seq in sorted((c for c in changes if c[0] == k), key=lambda c: (c[2], c[3])):
            last[on] = v
        kept = []
        for on in sorted(last):
            if not kept or kept[-1][0] != last[on]:
                kept.append((last[on], on))
        for (v, on), nxt in zip(kept, [*kept[1:], None]):
            out.append((k, v, on, nxt and nxt[1], nxt is None))
    return sorted(out, key=str)


change = st.tuples(st.integers(1, 3), st.sampled_from(["a", "b", None]), st.integers(0, 6))


@hypothesis_settings(max_examples=12, **fixture)
@given(st.lists(change, max_size=14), st.integers(0, 14))
def test_scd2_in_batches_equals_all_at_once(spark, raw, cut):
    """Also when later batches bring changes dated earlier."""
    changes = [(k, v, day(d), seq) for seq, (k, v, d) in enumerate(raw)]
    dim = spark.createDataFrame([], DIM)
    for batch in (changes[:cut], changes[cut:], changes):
        dim = history.scd2_merge(dim, spark.createDataFrame(batch, CHANGES), "k", "v", "on", "seq")
    assert values(dim) == brute(changes)


def test_scd2_leaves_other_keys_alone(spark):
    rows = [(1, "a", day(0), day(3), False), (1, "b", day(3), None, True), (2, "x", day(1), None, True)]
    changes = spark.createDataFrame([(2, "y", day(5), 1)], CHANGES)
    got = history.scd2_merge(spark.createDataFrame(rows, DIM), changes, "k", "v", "on", "seq")
    assert values(got) == sorted(
        [*rows[:2], (2, "x", day(1), day(5), False), (2, "y", day(5), None, True)], key=str
    )


def test_scd2_keeps_ends_and_gaps(spark):
    rows = [
        (1, "a", day(0), day(3), False),  # ended, not in the changes
        (2, "a", day(0), day(3), False),  # ended, opened again later with the same value
        (3, "a", day(0), day(9), False),  # a change before its end
        (4, "a", day(0), day(3), False),  # opened again on the day it ended
        (None, "n", day(0), None, True),
    ]
    changes = [(2, "a", day(5), 1), (3, "b", day(4), 2), (4, "b", day(3), 3), (None, "m", day(2), 4)]
    dim = spark.createDataFrame(rows, DIM)
    expected = [
        rows[0],
        rows[1],
        (2, "a", day(5), None, True),
        (3, "a", day(0), day(4), False),
        (3, "b", day(4), day(9), False),
        (4, "a", day(0), day(3), False),
        (4, "b", day(3), None, True),
        (None, "n", day(0), day(2), False),
        (None, "m", day(2), None, True),
    ]
    for _ in range(2):  # delivered again, nothing changes
        dim = history.scd2_merge(dim, spark.createDataFrame(changes, CHANGES), "k", "v", "on", "seq")
        assert values(dim) == sorted(expected, key=str)


def test_unchanged_keys_are_not_in_a_window(spark):
    """They go from the scan through an anti join to the result."""
    dim = spark.createDataFrame([(i, "a", day(0), None, True) for i in range(50)], DIM)
    dim = staged(dim, "dim")
    changes = spark.createDataFrame([(3, "b", day(1), 1)], CHANGES)
    got = history.scd2_merge(dim, changes, "k", "v", "on", "seq")
    assert got.count() == 51
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    first, _, rest = plan.partition("LeftAnti")
    assert "Window" not in first.partition("Union")[2].partition("Join")[0] and "LeftSemi" in rest


def test_cdc_operations_and_null_keys(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 40)], "k long, v long")
    changes = spark.createDataFrame(
        [(1, None, 11, 1), (2, "d", 0, 2), (3, "??", 0, 3), (4, " i ", 44, 4), (None, "U", 41, 5), (5, "D", 0, 6)],
        "k long, op string, v long, seq long",
    )
    for _ in range(2):
        target = history.cdc_apply(target, changes, "k", "op", "seq")
        assert values(target) == sorted([(1, 10), (3, 30), (4, 44), (None, 41)], key=str)
    assert [r.seq for r in history.cdc_rejected(changes, "op").orderBy("seq").collect()] == [1, 3]


ops = st.tuples(st.integers(1, 4), st.sampled_from("IUD"), st.one_of(st.none(), st.integers(0, 9)))


@hypothesis_settings(max_examples=12, **fixture)
@given(st.dictionaries(st.integers(1, 4), st.integers(10, 19)), st.lists(ops, max_size=10))
def test_cdc_apply(spark, target, raw):
    expected = dict(target)
    for k, op, v in raw:
        if op == "D":
            expected.pop(k, None)
        else:
            expected[k] = v
    changes = spark.createDataFrame([(*r, seq) for seq, r in enumerate(raw)], "k long, op string, v long, seq long")
    got = history.cdc_apply(
        spark.createDataFrame(list(target.items()), "k long, v long"), changes, "k", "op", "seq"
    )
    assert values(got) == sorted(expected.items(), key=str)


def test_upsert_takes_the_batch_over_the_dimension(spark):
    schema = "k long, v string, on date"
    dim = spark.createDataFrame([(1, "old", day(9)), (2, "kept", day(1))], schema)
    batch = spark.createDataFrame([(1, "x", day(2)), (1, "new", day(3)), (3, "added", day(1))], schema)
    assert values(history.dim_upsert(dim, batch, "k", ["on"])) == [
        (1, "new", day(3)),
        (2, "kept", day(1)),
        (3, "added", day(1)),
    ]
