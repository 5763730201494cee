"""Versions, publishing and what is left when a publish dies."""

import random
from pathlib import Path

import pytest
from helpers import frame, settings, txn, values
from pyspark.sql import types as T

from txnmart.operators.delta import find_new, merged
from txnmart.scratch import staged
from txnmart.sinks.store import APPEND, REPLACE, UPSERT, MartStore, VersionTaken, Written
from txnmart.sources.files import create_file


def test_nothing_published(store):
    assert store.at().version == 0
    assert store.read("t") is None
    with pytest.raises(LookupError):
        store.load_audit()


def test_replace_a_table_by_a_result_of_itself(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    store.publish({"t": merged(store.read("t"), frame(spark, txn(1), txn(2)))})
    assert [r[0] for r in values(store.read("t"))] == [1, 2]
    assert [r[0] for r in values(store.read("t", 1))] == [1]


def test_append_and_since(spark, store):
    for i in range(1, 4):
        store.append("t", frame(spark, txn(i)))
    assert store.at().rows("t") == 3
    assert [r[0] for r in values(store.at().read("t", since=1))] == [2, 3]
    assert store.at().read("t", since=3) is None
    store.publish({"t": store.read("t")})
    assert [r[0] for r in values(store.at().read("t", since=3))] == [1, 2, 3]


def test_written_but_not_committed_is_invisible(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    pending = store.write("t", frame(spark, txn(2)))
    assert pending.rows == 1
    assert [r[0] for r in values(store.read("t"))] == [1]
    assert [r[0] for r in values(store.written(pending))] == [2]


def test_write_that_fails_leaves_the_last_version(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    broken = frame(spark, txn(2)).selectExpr("*", "raise_error('lost') as x")
    with pytest.raises(Exception, match="lost"):
        store.publish({"t": broken})
    assert store.at().version == 1
    assert [r[0] for r in values(store.read("t"))] == [1]
    store.publish({"t": frame(spark, txn(3))})
    assert [r[0] for r in values(store.read("t"))] == [3]


def test_several_tables_appear_together(spark, store):
    a, b = store.write("a", frame(spark, txn(1))), store.write("b", frame(spark, txn(2)), APPEND)
    assert store.read("a") is None and store.read("b") is None
    assert store.commit(a, b) == 1
    assert store.read("a").count() == store.read("b").count() == 1
    assert values(store.load_audit()) == [(1, "a", "replace", 1), (1, "b", "append", 1)]


def test_empty_table_keeps_its_schema(spark, store):
    store.publish({"t": frame(spark)})
    assert store.read("t").count() == 0
    assert store.read("t").schema == frame(spark).schema


def test_second_writer_of_a_version_fails_and_the_first_stays(spark, store, monkeypatch):
    store.publish({"t": frame(spark, txn(1))})
    late = MartStore(spark, store.root)
    monkeypatch.setattr(late, "_newest", lambda: 0)  # it looked before the first one published
    with pytest.raises(VersionTaken):
        late.publish({"t": frame(spark, txn(2))})
    assert [r[0] for r in values(store.read("t"))] == [1]
    assert store.append("t", frame(spark, txn(3))) == 2


def test_a_claimed_version_without_entries_changes_nothing(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    create_file(spark, f"{store.root}/log/0000000002.json", "")
    assert [r[0] for r in values(store.read("t"))] == [1]
    assert store.append("t", frame(spark, txn(2))) == 3
    assert [r[0] for r in values(store.read("t"))] == [1, 2]


@pytest.mark.parametrize("keep", [0, -1])
def test_expire_never_deletes_the_newest_version(spark, store, keep):
    store.publish({"t": frame(spark, txn(1))})
    with pytest.raises(ValueError, match="keep"):
        store.expire(keep)
    assert [r[0] for r in values(store.read("t"))] == [1]


def test_expire_keeps_what_newer_versions_use(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    store.append("t", frame(spark, txn(2)))
    store.publish({"t": frame(spark, txn(3))})
    store.append("t", frame(spark, txn(4)))
    assert store.expire(keep=3) == 0
    assert [r[0] for r in values(store.read("t", 2))] == [1, 2]
    assert store.expire(keep=2) == 2
    assert store.expire(keep=2) == 0
    assert [r[0] for r in values(store.read("t"))] == [3, 4]
    assert [r[0] for r in values(store.read("t", 3))] == [3]


def test_unknown_version(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    with pytest.raises(LookupError):
        store.read("t", 2)


def fake(n, table="t", action=APPEND):
    return Written(table, action, f"/nowhere/{table}/{n}", 1, T.StructType())


def test_readers_take_the_last_fold_and_the_log_since(spark, store, monkeypatch):
    """What is read does not grow with the versions, old versions stay, a broken fold is passed over."""
    monkeypatch.setattr("txnmart.sinks.store.FOLD_EVERY", 8)
    read = []
    real = MartStore._lines

    def counted(self, files):
        read.append(len(files))
        return real(self, files)

    monkeypatch.setattr(MartStore, "_lines", counted)
    for n in range(1, 61):
        table = "u" if n % 5 == 0 else "t"
        store.commit(fake(n, table, REPLACE if n in (20, 21) else APPEND), name=f"s{n % 3}/{n}" if n % 2 else None)
    whole = MartStore(spark, store.root)
    read.clear()
    newest = whole.at()
    assert read[-1] <= 9 and newest.version == 60
    assert len(newest.entries) < 60

    def paths(snapshot, table):
        return [p.path for p in snapshot._parts(table)]

    for version in (1, 7, 8, 9, 19, 20, 21, 22, 47, 48, 60):
        own = [n for n in range(1, version + 1)]
        t = [n for n in own if n % 5]
        u = [n for n in own if not n % 5]
        t = t[t.index(21):] if 21 in t else t
        u = u[u.index(20):] if 20 in u else u
        at = whole.at(version)
        assert paths(at, "t") == [f"/nowhere/t/{n}" for n in t]
        assert paths(at, "u") == [f"/nowhere/u/{n}" for n in u]
        assert read[-1] <= 9
        assert at.has("s1/1") and at.has(f"s1/{version}") == (at.highest("s1") >= version)
    assert newest.highest("s2") == 59 and newest.highest("s9") == -1 and not newest.has("s9/0")
    folds = sorted(Path(store.root, "fold").glob("*.json"))
    assert len(folds) == 7
    cut = folds[-1].read_text()[:-40]
    for fold in folds[-2:]:
        fold.unlink()
        Path(fold.parent, f".{fold.name}.crc").unlink()
    create_file(spark, str(folds[-1]), cut)
    assert paths(whole.at(), "t") == paths(newest, "t")
    assert whole.at().rows("t") == newest.rows("t") and whole.at().commits("t") == newest.commits("t")


def test_a_fold_that_cannot_be_written_is_no_harm(spark, store, monkeypatch):
    monkeypatch.setattr("txnmart.sinks.store.FOLD_EVERY", 2)
    create_file(spark, f"{store.root}/fold/0000000002.json", "")
    for n in range(1, 6):
        assert store.commit(fake(n)) == n
    assert store.at().rows("t") == 5


def test_a_version_cut_short_is_left_out(spark, store):
    store.commit(fake(1), fake(1, "u"))
    whole = Path(store.root, "log", "0000000001.json").read_text().splitlines()
    for version, left in ((2, whole[0]), (3, whole[0] + "\n" + whole[1][:50])):
        left = left.replace('"version": 1', f'"version": {version}')
        create_file(spark, f"{store.root}/log/{version:010d}.json", left)
    assert store.at().version == 3 and len(store.at().entries) == 2 == len(store.at(1).entries)


def test_the_newest_version_is_found_without_a_listing(spark, store):
    for n in range(1, 41):
        store.commit(fake(n))
        assert MartStore(spark, store.root)._newest() == n


def test_files_that_cannot_hold_a_key_are_skipped(spark, store):
    """With ids in no order at all, appended in several batches."""
    rng = random.Random(3)
    numbers = rng.sample(range(1_000_000), 6000)
    for i in range(6):
        batch = frame(spark, *[txn(n) for n in numbers[i * 1000 : (i + 1) * 1000]]).repartition(4)
        with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
            store.commit(store.write("t", batch, APPEND, order="transaction_id"))
    mart = store.at()
    whole = mart.read("t")
    assert whole.count() == 6000
    keys = staged(spark.createDataFrame([(numbers[0],), (numbers[4500],)], "transaction_id long"), "keys")
    near = mart.near("t", keys, "transaction_id")
    found = near.join(keys, "transaction_id", "left_semi")
    assert sorted(r.transaction_id for r in found.collect()) == sorted([numbers[0], numbers[4500]])
    all_files, some = len(whole.inputFiles()), len(near.inputFiles())
    assert all_files == 24 and some <= 12
    none = staged(spark.createDataFrame([(2_000_000,)], "transaction_id long"), "keys")
    assert mart.near("t", none, "transaction_id") is None
    assert mart.near("t", keys.limit(0), "transaction_id") is None
    store.append("t", frame(spark, txn(None), txn(2_000_000)))  # without ranges: always read
    assert store.at().near("t", none, "transaction_id").count() == 1
    every = staged(whole.select("transaction_id"), "keys")
    assert mart.near("t", every, "transaction_id").count() == 6000
    new = [txn(n) for n in (numbers[7], 2_000_000, 2_000_001)]
    fresh = find_new(frame(spark, *new), lambda k: store.at().near("t", k, "transaction_id"))
    assert [r[0] for r in values(fresh.rows)] == [2_000_001] and fresh.known == 2


def test_upserts_take_the_place_of_their_keys(spark, store):
    schema = "k string, v int"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    store.publish({"t": rows(("a", 1), ("a", 2), ("b", 3), (None, 4))})
    store.commit(store.write("t", rows(("a", 5), ("c", 6)), UPSERT, key="k", gone=2))
    store.commit(store.write("t", rows((None, 7), ("c", 8), ("c", 9)), UPSERT, key="k", gone=2))
    assert values(store.read("t")) == sorted([("a", 5), ("b", 3), (None, 7), ("c", 8), ("c", 9)], key=str)
    assert store.at().rows("t") == 5 and store.at().upserts("t") == (2, 5)
    assert values(store.read("t", 2)) == sorted([("a", 5), ("b", 3), (None, 4), ("c", 6)], key=str)
    store.publish({"t": store.read("t")})
    assert store.at().upserts("t") == (0, 0) and store.read("t").count() == 5


def test_a_transaction_is_one_version(spark, store):
    store.publish({"t": frame(spark, txn(1))})
    together = store.transaction()
    assert together.append("t", frame(spark, txn(2))) == 2
    together.publish({"u": together.read("t")})
    assert together.at().rows("t") == 2 and store.read("u") is None and store.at().version == 1
    assert together.publish_all() == 2 and store.at().version == 2
    assert store.read("u").count() == 2 and store.transaction().publish_all() == 2
    late = store.transaction()
    late.append("t", frame(spark, txn(3)))
    store.append("t", frame(spark, txn(4)))
    with pytest.raises(VersionTaken):
        late.publish_all()
    assert [r[0] for r in values(store.read("t"))] == [1, 2, 4]


def test_expire_across_folds(spark, store, monkeypatch):
    monkeypatch.setattr("txnmart.sinks.store.FOLD_EVERY", 4)
    for n in range(10):
        written = store.write("t", frame(spark, txn(n)), REPLACE if n == 5 else APPEND, order="transaction_id")
        store.commit(written)
    assert store.expire(keep=3) == 5
    assert [r[0] for r in values(store.read("t"))] == [5, 6, 7, 8, 9]
    assert len(list(Path(store.root, "ranges", "t").iterdir())) == 5
