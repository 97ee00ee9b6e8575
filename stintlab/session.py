"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # Shuffle width is left to AQE: it coalesces small partitions and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows here are few but costly: tasks stay apart down to this size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # State of several parts per key needs this store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(
    app_name: str = "stintlab",
    extra_packages: list[str] | None = None,
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    if extra_packages:
        builder = builder.config("spark.jars.packages", ",".join(extra_packages))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
