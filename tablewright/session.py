"""Session settings this library is tuned for. Functions elsewhere never change the caller's session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split by shuffle block, so no single task gets a third of the rows
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    app_name: str = "tablewright", master: str | None = None, shuffle_partitions: int | None = None, **settings: str
) -> SparkSession:
    """A session with UTC time, adaptive execution and skew handling.

    On a cluster leave ``master`` to spark-submit and size ``shuffle_partitions`` so that the largest
    shuffle gives about 128 MB per partition; adaptive execution merges what turns out smaller.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
