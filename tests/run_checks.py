"""Check queries against their SQL: ``run_checks.py <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from compare import connect, difference  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from txnmart.session import mart_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    spark = mart_session(
        "checks",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        began = time.perf_counter()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            outcome = difference(con, sql, df) if sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            outcome = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if outcome is None else 'DIFF'} {time.perf_counter() - began:6.2f}s {name} {outcome or ''}", flush=True)
