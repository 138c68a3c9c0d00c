"""Session settings every layer relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings that decide results or plan quality; all can be set on a live
# session, so `configure` also works on a session somebody else started.
SETTINGS = {
    # Dates are derived from UTC timestamps.
    "spark.sql.session.timeZone": "UTC",
    # A money overflow must fail the job; dirty input goes through try_* functions.
    "spark.sql.ansi.enabled": "true",
    # Re-plan at run time: merge small partitions, split hot ones, switch to a
    # broadcast join only when the measured side is under the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join may keep lines partitioned by order although it also compares line ids; where that leaves
    # a partition hot, it is split even if what follows must then exchange its rows once more.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of a join's smaller side is measured to be small, it is hashed and the other side is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Writing one ingest date must leave the other dates alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # ingest_date stays text, as reports filter it as text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Rows one shuffle task should get: some hundred megabytes of order lines.
ROWS_PER_PARTITION = 2_000_000
PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def sized_shuffles(spark: SparkSession, row_count: int) -> Iterator[int]:
    """Within the block, at least as many shuffle partitions as a row count wants.

    Adaptive execution merges partitions that turn out small, but it cannot cut
    partitions that are evenly too large, so the number must be high enough. The
    session's own number holds again afterwards.
    """
    before = spark.conf.get(PARTITIONS)
    count = max(-(-row_count // ROWS_PER_PARTITION), int(before))
    spark.conf.set(PARTITIONS, str(count))
    try:
        yield count
    finally:
        spark.conf.set(PARTITIONS, before)


FREE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_exchanges(spark: SparkSession) -> Iterator[None]:
    """Within the block, what a query has exchanged goes from the disks when it ends, not when the driver collects its garbage.

    For blocks of writes and collects: a frame made here that is read bit by bit (``toLocalIterator``) ends, for Spark, before
    it is read. The session's own choice holds again afterwards.
    """
    before = spark.conf.get(FREE_EXCHANGES)
    spark.conf.set(FREE_EXCHANGES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_EXCHANGES, before)


def build_session(app_name: str = "tallyhouse", **options: str) -> SparkSession:
    """Start a session; pass extra options with dots written as double underscores."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in options.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
