"""Session settings shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet grows when it is read: judge a table's size for a broadcast by that.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Streams may remember more ids than an executor's heap holds.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def mart_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. On a cluster leave ``master`` to spark-submit; shuffle
    partitions, memory and ``spark.checkpoint.dir`` belong in its configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
