"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime settings that change results or keep skewed joins spread out.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot keys even where two joins share a partitioning and that costs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The default form of timestamps has no bounds in Parquet, so ranges of time would skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put an existing session into the state the operators expect.

    All timestamps are UTC. Left joins lean on adaptive skew splitting, so it is
    switched on explicitly. Memory, partition counts and the broadcast threshold
    stay with whoever owns the cluster.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "plantroom") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
