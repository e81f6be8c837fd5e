"""Session settings the library relies on or recommends."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Set on a session we build; on a cluster, pass the same settings at submit time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Window state lives on local disk with changelogs in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tidecast", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with the recommended settings; ``extra`` overrides or adds to them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps in the feeds are UTC, so the session must be too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
