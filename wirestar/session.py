"""Sessions, and the settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# For every session. Adaptive execution sizes shuffle partitions, turns joins with a
# side measured as small into broadcasts, and splits skewed partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cpus: int | str = "*", name: str = "wirestar") -> SparkSession:
    """A single-machine session for tests and the benchmark. On a cluster, submit the
    jobs with ``SETTINGS`` and leave the partition counts to the cluster's defaults."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
