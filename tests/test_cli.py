"""The command line, from generated rows to a report."""

import json

from txnmart.__main__ import main
from txnmart.sinks.store import MartStore
from txnmart.sources.files import create_file


def last(capsys):
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_generate_run_and_report(spark, tmp_path, capsys):
    mart, feed = str(tmp_path / "mart"), str(tmp_path / "feed")
    days = ["--start", "2024-01-01", "--end", "2024-03-31"]
    assert main(["generate", "--rows", "300", *days, "--output", feed]) == 0
    assert main(["run", "--mart", mart, "--source", feed, "--load-time", "2026-03-12 08:00:00"]) == 0
    assert last(capsys) == {"job": "run", "status": "LOADED", "rows": 300, "version": 1}
    assert main(["ingest", "--mart", mart, "--source", feed, "--incremental"]) == 0
    assert last(capsys)["status"] == "UNCHANGED"
    assert main(["load", "--mart", mart, "--incremental"]) == 0
    assert last(capsys)["status"] == "UNCHANGED"
    assert main(["totals", "--mart", mart]) == 0
    assert last(capsys)["status"] == "LOADED"
    assert main(["ingest", "--mart", mart, "--source", feed]) == 0
    assert main(["expire", "--mart", mart, "--keep", "1"]) == 0
    assert last(capsys) == {"job": "expire", "deleted": 1}
    assert main(["audit", "--mart", mart]) == 0
    assert "fact_transactions" in capsys.readouterr().out
    assert main(["top-spenders", "--mart", mart, "--limit", "3"]) == 0
    assert capsys.readouterr().out.count("CUSTOMER ") == 3


def test_stream(spark, tmp_path, capsys):
    mart, feed, state = (str(tmp_path / n) for n in ("mart", "feed", "state"))
    job = ["stream", "--mart", mart, "--source", f"{feed}/*", "--state", state]
    assert main(job) == 0
    assert last(capsys)["status"] == "SKIPPED_NO_SOURCE"
    for part, rows in enumerate(["40", "60"]):
        days = ["--start", "2024-01-01", "--end", "2024-03-31"]
        main(["generate", "--rows", rows, *days, "--output", f"{feed}/{part}"])
        assert main(job) == 0
        assert last(capsys)["rows"] == [40, 20][part]
    assert main(job) == 0
    assert last(capsys)["status"] == "UNCHANGED"


def test_missing_source(spark, tmp_path, capsys):
    job = ["ingest", "--mart", str(tmp_path / "mart"), "--source", str(tmp_path / "no.csv")]
    assert main(job) == 0
    assert last(capsys)["status"] == "SKIPPED_NO_SOURCE"
    assert main(["--strict", *job]) == 1


def test_audit_prints_every_version_newest_first(spark, tmp_path, capsys):
    root = str(tmp_path / "mart")
    store = MartStore(spark, root)
    store.append("t", spark.range(1))
    entry = json.loads(store.log().toJSON().first())
    for version in range(2, 376):
        lines = [json.dumps({**entry, "version": version, "table_name": f"t{i}"}) for i in range(4)]
        create_file(spark, f"{root}/log/{version:010d}.json", "\n".join(lines))
    assert main(["audit", "--mart", root]) == 0
    rows = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert len(rows) == 1 + 374 * 4 and rows[0]["version"] == 375 and rows[-1]["version"] == 1
    assert main(["audit", "--mart", root, "--versions", "2"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 8


def test_stream_totals_into_a_mart(spark, tmp_path):
    mart, source = str(tmp_path / "mart"), str(tmp_path / "events")
    spark.sql("select timestamp_ntz'2024-01-01 10:00:00' as ts, 2.5 as value").write.parquet(source)
    assert main(["stream-totals", "--mart", mart, "--source", source, "--state", str(tmp_path / "state")]) == 0
    days = MartStore(spark, mart).read("stream_days").collect()
    assert [(r.transactions, r.total_amount, r.late_transactions, r.final) for r in days] == [(1, 2.5, 0, False)]
