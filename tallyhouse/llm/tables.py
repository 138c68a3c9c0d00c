"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within the block, at most so many rows in one Arrow batch; a batch is held whole by the JVM and by Python.

    Works on what is written within the block. The session's own number holds again afterwards.
    """
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; null for a null key."""
    return F.crc32(key.cast("string")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, dict[int, int]]:
    """``label, text`` of at most ``most`` labelled keys of each of the labels 0 and 1, and how many keys have each.

    The keys with the smallest hashes are taken, always the same ones. They are at most
    ``2 * most`` numbers, so they are broadcast, and no text is moved that is not in the sample.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where("key is not null and label in (0, 1)")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    slot = F.pmod(F.xxhash64(F.lit(label), "key"), F.lit(1 << 40))
    taken = None
    for value, count in sorted(counts.items()):
        share = int(min(1.0, 1.5 * most / count) * (1 << 40))  # leaves little for the top-k to sort
        part = known.where((F.col("label") == value) & (slot < share)).orderBy(slot, "key").limit(most)
        taken = part if taken is None else taken.unionByName(part)
    if taken is None:
        taken = known
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")
    return texts.join(F.broadcast(taken), "key").select("label", "text"), counts
