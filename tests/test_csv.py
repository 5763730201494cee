"""CSV files whose columns come in another order, or are not the expected ones."""

import gc
import gzip

import pytest
from helpers import values

from txnmart.operators.quality import csv_verdict
from txnmart.plans import mart
from txnmart.schemas import COLUMNS, CORRUPT
from txnmart.scratch import staged
from txnmart.sources.files import HeaderMismatch, csv_scan, headers

ROWS = [("1", "A, Inc", "a@x.y", "M", "1.50", "2024-01-02"), ("2", "B", "", "N", "2.25", "2024-01-03")]


def put(folder, name, columns, rows=ROWS, opened=open):
    folder.mkdir(exist_ok=True)
    at = {c: i for i, c in enumerate(COLUMNS)}
    with opened(folder / name, "wt") as f:
        for row in [columns, *[[row[at[c]] if c in at else "?" for c in columns] for row in rows]]:
            f.write(",".join(f'"{v}"' if "," in v else v for v in row) + "\n")
    return str(folder)


def test_columns_are_taken_by_name(spark, tmp_path):
    plain = put(tmp_path / "plain", "a.csv", COLUMNS)
    expected = values(csv_scan(spark, plain))
    assert expected[0][1] == "A, Inc"
    for order in (COLUMNS[::-1], [COLUMNS[0], COLUMNS[2], COLUMNS[1], *COLUMNS[3:]]):
        folder = put(tmp_path / "-".join(order)[:30], "a.csv", order)
        assert values(csv_scan(spark, folder)) == expected


def test_files_of_one_folder_may_differ(spark, tmp_path):
    folder = put(tmp_path / "in", "a.csv", COLUMNS, ROWS[:1])
    put(tmp_path / "in", "b.csv", COLUMNS[::-1], ROWS[1:])
    put(tmp_path / "in", "c.csv.gz", [COLUMNS[1], COLUMNS[0], *COLUMNS[2:]], ROWS[:1], gzip.open)
    (tmp_path / "in" / "empty.csv").touch()
    (tmp_path / "in" / "_SUCCESS").write_text("x")
    assert len(headers(spark, folder)) == 3
    scan = csv_scan(spark, folder)
    assert sorted(r.transaction_id for r in scan.collect()) == [1, 1, 2]
    assert all(r[CORRUPT] is None for r in scan.collect())


@pytest.mark.parametrize(
    ("columns", "said"),
    [
        (COLUMNS[:-1], "missing transaction_date"),
        ([*COLUMNS, "note"], "unknown note"),
        ([*COLUMNS[:-1], "date"], "missing transaction_date; unknown date"),
        ([*COLUMNS, COLUMNS[0]], "repeated transaction_id"),
    ],
)
def test_wrong_headers_are_refused(spark, store, tmp_path, columns, said):
    folder = put(tmp_path / "in", "a.csv", columns)
    with pytest.raises(HeaderMismatch, match=said):
        csv_scan(spark, folder)
    with pytest.raises(HeaderMismatch):
        mart.ingest(store, folder)
    assert store.at().version == 0


def test_no_rows(spark, tmp_path):
    folder = put(tmp_path / "in", "a.csv", COLUMNS, [])
    assert csv_scan(spark, folder).count() == 0
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").touch()
    assert csv_scan(spark, str(tmp_path / "none")).count() == 0
    assert headers(spark, str(tmp_path / "none")) == {}
    assert headers(spark, str(tmp_path / "missing")) == {} == headers(spark, [])


def test_the_driver_does_nothing_per_file(spark, tmp_path):
    """As many calls into the JVM for many files as for few, in any order of columns."""
    client = spark.sparkContext._gateway._gateway_client
    send, calls = type(client).send_command, []

    def counted(self, *args, **more):
        calls[-1] += 1
        return send(self, *args, **more)

    for n in (2, 4, 120):  # the first warms up
        for i in range(n):
            put(tmp_path / f"in-{n}", f"{i} %.csv", COLUMNS if i % 2 else COLUMNS[::-1])
        gc.collect()
        calls.append(0)
        type(client).send_command = counted
        try:
            found = headers(spark, str(tmp_path / f"in-{n}"))
        finally:
            type(client).send_command = send
        assert sorted(map(len, found.values())) == [n // 2, n // 2]
        assert csv_scan(spark, str(tmp_path / f"in-{n}")).count() == 2 * n
    assert calls[1] > 0 and abs(calls[2] - calls[1]) < 60


def test_only_the_first_line_is_read(spark, tmp_path):
    """A file of many splits has one header, and its task stops there."""
    folder = put(tmp_path / "in", "a.csv", COLUMNS, ROWS * 200_000)
    (tmp_path / "in" / "b.csv").write_text("\n \n" + ",".join(COLUMNS) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert [len(f) for f in headers(spark, folder).values()] == [2]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert csv_scan(spark, folder).count() == 400_000


def test_files_in_folders_below(spark, tmp_path):
    put(tmp_path / "in", "a.csv", COLUMNS, ROWS[:1])
    (tmp_path / "in" / "day=1").mkdir()
    put(tmp_path / "in" / "day=1", "b.csv", COLUMNS, ROWS[1:])
    scan = csv_scan(spark, str(tmp_path / "in"))
    assert scan.columns == [*COLUMNS, CORRUPT] and scan.count() == 2


def test_bytes_are_checked(spark, tmp_path):
    """A broken byte is told from the character that stands for one."""
    lines = [b"1,ann \xef\xbf\xbd,a@x.y,M\xc3\xbcller,1.5,2024-01-02", b"2,j\xff,j@x.y,m,1.5,2024-01-02",
             b"3,bob,b@x.y,m,\xe9,2024-01-02", b"4,eve,e@x.y,m,x,2024-01-02", b"5,\xe2\x82,e@x.y,m,1,2024-01-02"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(",".join(COLUMNS).encode() + b"\n" + b"\n".join(lines) + b"\n")
    scan = staged(csv_scan(spark, str(tmp_path / "in"), check_bytes=True), "csv-bytes")
    got = {r.transaction_id: (r.verdict, r.customer_name, r.merchant_name) for r in csv_verdict(scan).collect()}
    assert got == {
        1: ("good", "ann \ufffd", "M\u00fcller"),
        2: ("encoding", "j\ufffd", "m"),
        3: ("encoding", "bob", "m"),
        4: ("malformed", "eve", "m"),
        5: ("encoding", "\ufffd", "m"),
    }
    plain = csv_scan(spark, str(tmp_path / "in")).select(COLUMNS)
    assert values(plain) == values(scan.select(COLUMNS))
    assert csv_scan(spark, str(tmp_path / "nothing"), check_bytes=True).count() == 0
