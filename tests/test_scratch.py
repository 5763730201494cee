"""Intermediate tables and their end."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import values

from txnmart.scratch import CLEANUP, staged, temporary
from txnmart.sources.files import matching_paths


def there(spark, df):
    return [bool(matching_paths(spark, f)) for f in df.inputFiles()]


def test_what_is_not_kept_goes(spark):
    with temporary(spark) as outer:
        with temporary(spark) as inner:
            a, b = staged(spark.range(3), "a"), staged(spark.range(4), "b")
            c = inner.keep(staged(a.join(b, "id"), "c"))
        gone = [*a.inputFiles(), *b.inputFiles()]
        assert not any(matching_paths(spark, f) for f in gone)
        assert all(there(spark, c)) and len(values(c)) == 3
        d = outer.keep(staged(c.where("id > 0"), "d"))
    assert not any(there(spark, c)) and all(there(spark, d))
    assert values(d) == [(1,), (2,)]


def test_a_block_that_fails_cleans_up_too(spark):
    with pytest.raises(OSError, match="stop"), temporary(spark):
        a = staged(spark.range(3), "a")
        raise OSError("stop")
    assert not any(there(spark, a))


def test_settings_are_left_as_they_were(spark):
    before = spark.conf.get(CLEANUP, None)
    staged(spark.range(1), "a")
    assert spark.conf.get(CLEANUP, None) == before


def test_settings_are_left_as_they_were_by_threads(spark):
    before = spark.conf.get(CLEANUP, None)
    for _ in range(3):
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda n: staged(spark.range(n), "a").count(), range(4)))
        assert spark.conf.get(CLEANUP, None) == before
