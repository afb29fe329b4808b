"""Session settings the toolkit relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. UTC makes epoch values of
# zone-less timestamps independent of the machine; adaptive execution splits
# skewed join partitions; RocksDB keeps window state off the JVM heap, and its
# change log makes a checkpoint as small as what changed. Replays look at the progress of
# every micro-batch. Whole texts make rows heavy: fewer of them go to Python at once.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(
    cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("streamlookup")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
