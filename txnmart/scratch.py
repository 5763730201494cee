"""Intermediate tables in the shared folder the cluster names.

Lineage is cut by writing parquet there and reading it back: the result survives the
loss of any executor, keeps column pruning and file statistics (so Spark can decide on a
broadcast from the real size), and fixes values that a recomputation could change.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_fallback: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and the session is
    local (tests, a laptop), a fresh temporary folder per application."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="run-txnmart-")
    return _local_fallback[app]


def application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/txnmart-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nothing else uses."""
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged. Frames that still read it stop working, so
    call this at the end of a job, when its results have been written elsewhere."""
    delete_folder(spark, application_folder(spark))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system it lives on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


# From Spark 4.1 on: delete the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_cleaning: list[str | None] = []  # the setting as it was, once per write that runs
_lock = threading.Lock()


@contextmanager
def _cleaning_up(spark: SparkSession) -> Iterator[None]:
    """The setting on while any thread is in the block, and then as it was before the first."""
    with _lock:
        _cleaning.append(_cleaning[0] if _cleaning else spark.conf.get(CLEANUP, None))
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            before = _cleaning.pop()
            if not _cleaning:
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return a scan of what was written. What was
    shuffled on the way is not needed any more and is deleted at once, where Spark can."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _cleaning_up(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if _open:
        _open[-1].frames.append((out, path))
    return out


class Temporary:
    """What was staged since a :func:`temporary` block began."""

    def __init__(self) -> None:
        self.frames: list[tuple[DataFrame, str]] = []
        self.kept: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Let a staged frame outlive the block."""
        self.kept += [f for f in self.frames if f[0] is df]
        self.frames = [f for f in self.frames if f[0] is not df]
        return df


_open: list[Temporary] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Temporary]:
    """Delete what is staged inside the block when it ends, but for what it keeps: frames that
    read anything else of it stop working. Blocks nest; what an inner one keeps is the outer
    one's to delete. For one thread."""
    mine = Temporary()
    _open.append(mine)
    try:
        yield mine
    finally:
        _open.remove(mine)
        for _, path in mine.frames:
            delete_folder(spark, path)
        if _open:
            _open[-1].frames += mine.kept
