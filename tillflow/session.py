"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. Adaptive execution is what splits hot join keys and hot
# date slices, so no job here is correct to tune without it.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Folders of slices are listed by this many tasks, not by one for each folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


# Map tasks sort or fold what they read before it moves. So many bytes of a file at most, and what they hold
# stays in memory, however large the table; larger blocks spill all of it to disk and read it back.
MAX_PARTITION_BYTES = 16 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return bound_tasks(spark)


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Keep what one task holds small on large tables; a session that asks for less keeps its own settings."""
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > MAX_PARTITION_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{MAX_PARTITION_BYTES}b")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, scratch_dir: str | None = None) -> SparkSession:
    """A single-machine session for tests and the bench; `scratch_dir` holds intermediate tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Small test files are worth splitting: the default would read them in one or two tasks.
        .config("spark.sql.files.openCostInBytes", str(512 * 1024))
    )
    spark = (builder.config("spark.checkpoint.dir", scratch_dir) if scratch_dir else builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
