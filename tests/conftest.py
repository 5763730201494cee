import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from txnmart.session import mart_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = mart_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.files.minPartitionNum": "8",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-txnmart-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from txnmart.sinks.store import MartStore

    return MartStore(spark, str(tmp_path / "mart"))
