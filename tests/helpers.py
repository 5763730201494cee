"""Small frames and result access for tests."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

from txnmart.schemas import COLUMNS, TRANSACTION


def txn(i, name="ANN", email="a@x.org", merchant="SHOP", amount=10.0, day="2024-01-07"):
    return (i, name, email, merchant, amount, dt.date.fromisoformat(day) if day else None)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), TRANSACTION)


def text(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in COLUMNS))


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **conf):
    """Session settings for a while; dots in names are written as double underscores."""
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
