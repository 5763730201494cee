"""What is written and shuffled for a job grows no faster than its input."""

import datetime as dt

import pytest
from helpers import frame, plan, settings, txn, values
from pyspark.sql import functions as F

import txnmart.streaming.ingest as ingest
from txnmart.checks import queries
from txnmart.plans import mart
from txnmart.schemas import COLUMNS
from txnmart.sinks.store import MartStore
from txnmart.sources import files
from txnmart.sources.testtables import text_transactions, transactions


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two customers, three orders (one of nobody), five line items (one of no order, one whose
    quantity makes its text feed untidy)."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1999, 12, 31)
    made = {
        "customer": ([(1, "ANN"), (2, "BOB")], "c_custkey long, c_name string"),
        "supplier": ([(5, "Shop")], "s_suppkey long, s_name string"),
        "orders": ([(10, 1), (11, 2), (12, 9)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(o, n, 5, 3.0 if o == 11 else 8.0, 1.5 * n, day) for o, n in ((10, 1), (10, 1), (11, 2), (12, 1), (13, 1))],
            "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, "
            "l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_line_items_are_shuffled_for_their_buyer_alone(spark, tables):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for feed in (transactions, text_transactions):
            text = plan(feed(spark, tables))
            assert text.index("Left keys [1]: [o_custkey") < text.index("Left keys [1]: [l_orderkey")
    rows = values(transactions(spark, tables))
    assert [r[0] for r in rows] == [101, 101, 112]
    assert rows[2][1:] == (" bob ", "user2@example.com", "shop ", 3.0, dt.date(1999, 12, 31))
    assert [r[5] for r in values(text_transactions(spark, tables))] == ["1999-12-31"] * 3


@pytest.mark.parametrize("codec", ["lz4", "gzip"])
def test_compressed_deliveries_are_many_files(spark, tmp_path, monkeypatch, codec):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 2)
    feed = frame(spark, *[txn(i, f" N{i} ") for i in range(5)]).coalesce(1)
    files.write_csv(feed, str(tmp_path / "in"), compression=codec)
    assert len(list((tmp_path / "in").glob("part-*"))) == 3
    assert not list((tmp_path / "in").glob("*.csv"))
    assert values(files.csv_scan(spark, str(tmp_path / "in")).select(COLUMNS)) == values(feed)


def test_the_mart_and_stream_feeds_are_compressed(spark, tables, monkeypatch):
    seen = []
    real = files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda *a, **more: seen.append(more) or real(*a, **more))
    for name in ("mart_end_to_end", "mart_validated_run", "stream_ingest_lines"):
        assert queries.QUERIES[name](spark, tables).count() > 0
    assert [m.get("compression") for m in seen] == ["lz4", "lz4", "gzip", "gzip"]


def test_what_was_deduplicated_is_not_written_again_for_the_rules(spark, store, monkeypatch):
    labels = []
    real = mart.staged
    monkeypatch.setattr(mart, "staged", lambda df, label: labels.append(label) or real(df, label))
    days = ("2024-01-01", "2024-12-31")
    for dedup in (True, False):
        labels.clear()
        mart.ingest_frame(store, frame(spark, txn(1), txn(1), txn(2), txn(3, amount=-1.0)))
        mart.transform(store, mart.Checks(dedup=dedup, days=days))
        assert ("to-check" in labels) is not dedup and "checked" in labels
    assert [r.transaction_id for r in store.read(mart.SILVER).orderBy("transaction_id").collect()] == [1, 2]
    assert store.read(mart.QUARANTINE).count() == 3  # the negative one, and two that share an id


def test_a_first_delivery_is_not_joined_with_its_ids(spark, store, tmp_path, monkeypatch):
    written = []
    real = MartStore.write

    def write(self, table, df, *args, **more):
        if table == "t":
            written.append("LeftSemi" in plan(df))
        return real(self, table, df, *args, **more)

    monkeypatch.setattr(MartStore, "write", write)
    for n, part in enumerate(([txn(1), txn(2), txn(2), txn(None)], [txn(2), txn(3)])):
        files.write_csv(frame(spark, *part).coalesce(1), f"{tmp_path}/in/{n}")
        stream = ingest.csv_stream(spark, f"{tmp_path}/in/*")
        ingest.ingest_available(store, "t", stream, str(tmp_path / "state"))
    assert written == [False, True]
    assert [r.transaction_id for r in store.read("t").orderBy("transaction_id").collect()] == [1, 2, 3]


def test_a_history_batch_is_deduplicated_once(spark, tables, monkeypatch):
    plans = []
    real = mart.append_new
    monkeypatch.setattr(mart, "append_new", lambda s, t, b: plans.append(plan(b)) or real(s, t, b))
    assert queries.customer_history(spark, tables).count() == 2
    assert len(plans) == 2 and not any("Window" in p for p in plans)


def test_what_stays_is_written_small(spark, store):
    store.append("t", frame(spark, txn(1)).where(F.lit(True)))
    assert all(f.endswith(".zstd.parquet") for f in store.read("t").inputFiles())
