"""Session settings this library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "stridecast", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC times and adaptive execution; cluster sizing is left to the caller.

    Adaptive execution coalesces small shuffle partitions, splits skewed ones in
    joins and rebalanced writes, and turns a shuffled join into a broadcast only
    after it has seen the real size of the small side.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        # Window state on executor disk instead of the JVM heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
