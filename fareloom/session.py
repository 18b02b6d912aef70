"""Session settings the package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter for results or for plans. Everything else stays with the cluster.
SETTINGS = {
    # Wall clocks are read as UTC everywhere (see functions/timefn.py).
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing, skewed-join splitting, late broadcast.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of the partitions AQE merges and splits to, hence of the files written.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    # Small sides are staged, so this bound is held against their true size (sources/staging.py).
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Streaming state outside the heap; it grows with keys times open windows.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Bytes a shuffle task should handle.
SHUFFLE_TARGET = 256 * 1024**2
# Blocks to keep track of grow with map tasks times partitions; past this, tasks spill instead.
FEWEST_PARTITIONS, MOST_PARTITIONS = 200, 50_000


def partitions_for(shuffled_bytes: int, target: int = SHUFFLE_TARGET) -> int:
    """Shuffle partitions for that much data. AQE merges those that turn out small."""
    return min(MOST_PARTITIONS, max(FEWEST_PARTITIONS, -(-shuffled_bytes // target)))


def build_session(
    app: str = "fareloom",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with SETTINGS applied; `extra` keys use `__` for dots.

    `shuffled_bytes`, the size of the largest shuffle expected, sets the number of partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(partitions_for(shuffled_bytes))
    settings |= {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
