"""Streaming paths against their batch results."""

import contextlib
import datetime as dt
from pathlib import Path

from helpers import frame, txn, values
from pyspark.sql import functions as F

from txnmart.operators import members
from txnmart.plans import mart
from txnmart.sources.files import write_csv
from txnmart.streaming import ingest
from txnmart.streaming.ingest import csv_stream, ingest_available, merge_batch
from txnmart.streaming.totals import (
    STREAM_DAYS,
    daily_totals_stream,
    total_available,
    utc_instant,
    write_available,
)


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_files_arriving_in_parts_are_merged_once(spark, store, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    parts = [[txn(1), txn(2)], [txn(2), txn(3), txn(3)], [txn(None), txn(4)]]
    for n, part in enumerate(parts):
        write_csv(frame(spark, *part).coalesce(1), f"{folder}/part-{n}")
        ingest_available(store, "t", csv_stream(spark, f"{folder}/*", files_per_batch=1), state)
    assert ids(store.read("t")) == [1, 2, 3, 4]
    assert store.read("t_quarantine").count() == 1
    version = store.at().version
    ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
    assert store.at().version == version


def test_rows_that_are_known_meet_no_new_ids(spark, store, tmp_path, monkeypatch):
    """Of a delivery that mostly repeats what has come, few rows are moved to find the new ones."""
    folder, state, moved = tmp_path / "in", str(tmp_path / "state"), []
    real = ingest.apart

    def look(rows, keys, key, count):
        may_be_new, others = real(rows, keys, key, count)
        moved.append((count, may_be_new.count()))
        return may_be_new, others

    monkeypatch.setattr(ingest, "apart", look)
    monkeypatch.setattr(members, "FEWEST", 1)
    for n, last in enumerate((900, 1000)):
        write_csv(frame(spark, *[txn(i) for i in range(last)], txn(None)), f"{folder}/part-{n}", compression="gzip")
        ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
    assert ids(store.read("t")) == list(range(1000))
    (count, rows), = moved
    assert count == 100 and 100 <= rows < 400


def test_a_batch_run_again_adds_nothing(spark, store):
    batch = frame(spark, txn(1, " ann "), txn(2))
    merge_batch(store, "t", batch)
    merge_batch(store, "t", batch)
    assert ids(store.read("t")) == [1, 2]
    assert store.at().version == 1
    assert {r.customer_name for r in store.read("t").collect()} == {"ANN"}


def test_a_batch_committed_before_a_crash_is_left_alone(spark, store):
    batch = frame(spark, txn(None), txn(1))
    for _ in range(2):
        merge_batch(store, "t", batch, "stream/0")
    assert store.read("t_quarantine").count() == 1
    merge_batch(store, "t", batch, "stream/1")
    assert store.read("t_quarantine").count() == 1  # the same row, delivered again
    assert ids(store.read("t")) == [1]


def test_batches_are_named_by_stream_and_number(spark, store, tmp_path):
    for n in range(2):
        write_csv(frame(spark, txn(n)).coalesce(1), f"{tmp_path}/in/part-{n}")
    stream = csv_stream(spark, f"{tmp_path}/in/*", files_per_batch=1)
    ingest_available(store, "t", stream, str(tmp_path / "state"))
    names = [r.commit for r in store.log().orderBy("version").collect()]
    assert [n.split("/")[1] for n in names] == ["0", "1"]
    assert len({n.split("/")[0] for n in names}) == 1 and "None" not in names[0]


def land(spark, folder, number, *rows):
    write_csv(frame(spark, *rows).coalesce(1), f"{folder}/part-{number}")


def test_ids_of_other_jobs_are_known_to_the_stream(spark, store, tmp_path):
    folder, state = f"{tmp_path}/in", str(tmp_path / "state")
    mart.append_new(store, "t", frame(spark, txn(1), txn(2)))
    for n, (part, others) in enumerate([([1, 3], [4]), ([3, 4, 5], [6, 5]), ([6, 7, 1], [])]):
        land(spark, folder, n, *map(txn, part))
        ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
        mart.append_new(store, "t", frame(spark, *map(txn, others)))
    assert ids(store.read("t")) == [1, 2, 3, 4, 5, 6, 7]


def test_a_micro_batch_reads_nothing_of_the_table(spark, store, tmp_path):
    folder, state = f"{tmp_path}/in", str(tmp_path / "state")
    for n, part in enumerate(([1, 2], [2, 3], [3, 3, 4])):
        land(spark, folder, n, *map(txn, part))
        if n == 2:  # whatever would open the table's rows fails now
            for path in store.at().paths():
                for file in Path(path).glob("*.parquet"):
                    file.write_bytes(b"no parquet")
        ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
    assert ids(store.at().read("t", since=store.at().version - 1)) == [4]


def test_a_stream_that_dies_at_any_point_goes_on(spark, store, tmp_path, monkeypatch):
    """Before and after the landing, the write and the commit: in the end every row is there once."""
    from txnmart.streaming import ingest

    folder, state = f"{tmp_path}/in", str(tmp_path / "state")
    n = 0
    for name, late in [("dedup_batch", 0), ("write_rejected", 0), ("create_file", 0), ("delete_folder", 0),
                       ("_append_landed", 1), ("_seed", 1)]:
        land(spark, folder, n, txn(n), txn(n // 2), txn(None, f"N{n}"))
        real = getattr(ingest, name)

        def dies(*args, real=real, late=late, **more):
            if late:
                real(*args, **more)
            raise OSError("killed")

        with monkeypatch.context() as broken:
            broken.setattr(ingest, name, dies)
            with contextlib.suppress(Exception):
                ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
        if n % 2:
            mart.append_new(store, "t", frame(spark, txn(100 + n)))
        n += 1
    land(spark, folder, n, txn(101), txn(0), txn(103))
    ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
    assert ids(store.read("t")) == [0, 1, 2, 3, 4, 5, 101, 103, 105]
    assert sorted(r.customer_name for r in store.read("t_quarantine").collect()) == [f"N{i}" for i in range(n)]


def test_a_replaced_table_begins_a_new_state(spark, store, tmp_path):
    folder, state = f"{tmp_path}/in", str(tmp_path / "state")
    land(spark, folder, 0, txn(1), txn(2))
    ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
    store.publish({"t": frame(spark, txn(2), txn(9))})
    land(spark, folder, 1, txn(1), txn(2), txn(9), txn(3))
    ingest_available(store, "t", csv_stream(spark, f"{folder}/*"), state)
    assert ids(store.read("t")) == [1, 2, 3, 9]


def events(spark, path, *rows):
    spark.createDataFrame(rows, "ts timestamp_ntz, value double").coalesce(1).write.mode("append").parquet(path)


def test_days_appear_when_final_and_late_events_are_left_out(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def step():
        stream = spark.readStream.schema("ts timestamp_ntz, value double").parquet(source)
        stream = stream.withColumn("ts", utc_instant(F.col("ts")))
        write_available(daily_totals_stream(stream, "1 hour"), out, state)
        return values(spark.read.parquet(out)) if list((tmp_path / "out").glob("*.parquet")) else []

    at = dt.datetime
    events(spark, source, (at(2024, 1, 1, 23), 1.0), (at(2024, 1, 2, 0, 30), 2.0))
    assert step() == []
    events(spark, source, (at(2024, 1, 1, 23, 50), 4.0), (at(2024, 1, 2, 2), 8.0))
    assert step() == [(dt.date(2024, 1, 1), 2, 5.0)]
    events(spark, source, (at(2024, 1, 1, 12), 16.0), (at(2024, 1, 3, 2), 32.0))
    assert step() == [(dt.date(2024, 1, 1), 2, 5.0), (dt.date(2024, 1, 2), 2, 10.0)]


def test_days_are_utc_in_any_session_zone(spark, tmp_path):
    events(spark, str(tmp_path / "in"), (dt.datetime(2024, 1, 1, 0, 30), 1.0), (dt.datetime(2024, 1, 5), 1.0))
    for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        stream = spark.readStream.schema("ts timestamp_ntz, value double").parquet(str(tmp_path / "in"))
        totals = daily_totals_stream(stream.withColumn("ts", utc_instant(F.col("ts"))), "1 hour")
        out = str(tmp_path / f"out-{zone.replace('/', '-')}")
        write_available(totals, out, f"{out}-state")
        assert values(spark.read.parquet(out)) == [(dt.date(2024, 1, 1), 1, 1.0)]


def test_every_event_is_counted_or_late(spark, store, tmp_path):
    """Files out of order: what is published is as with the watermark, and the rest is told."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = dt.datetime
    parts = [
        [(at(2024, 1, 1, 23), 1.0), (at(2024, 1, 2, 0, 30), 2.0), (None, 64.0)],
        [(at(2024, 1, 1, 23, 50), 4.0), (at(2024, 1, 2, 2), 8.0)],
        [(at(2024, 1, 1, 12), 16.0), (at(2024, 1, 3, 2), 32.0), (at(2023, 12, 31), 5.0)],
        [(at(2024, 1, 2, 9), 7.0), (at(2024, 1, 3, 3), 0.5), (at(2023, 12, 31, 1), 5.0), (None, 1.0)],
    ]
    seen = 0
    for part in parts:
        events(spark, source, *part)
        seen += len(part)
        for _ in range(2):  # the second time nothing has arrived
            stream = spark.readStream.schema("ts timestamp_ntz, value double").parquet(source)
            stream = stream.withColumn("ts", utc_instant(F.col("ts")))
            total_available(store, stream, "1 hour", str(tmp_path / "days-state"))
            write_available(daily_totals_stream(stream, "1 hour"), out, str(tmp_path / "state"))
        days = store.read(STREAM_DAYS)
        assert days.selectExpr("sum(transactions) + sum(late_transactions)").first()[0] == seen
        published = values(spark.read.schema("day date, transactions long, total_amount double").parquet(out))
        assert values(days.where("final").select("day", "transactions", "total_amount")) == published
    day = dt.date
    assert values(days.drop("newest")) == sorted(
        [
            (None, 2, 65.0, 0, False),
            (day(2023, 12, 31), 0, 0.0, 2, False),
            (day(2024, 1, 1), 2, 5.0, 1, True),
            (day(2024, 1, 2), 2, 10.0, 1, True),
            (day(2024, 1, 3), 2, 32.5, 0, False),
        ],
        key=str,
    )
    assert store.at().version == len(parts)
