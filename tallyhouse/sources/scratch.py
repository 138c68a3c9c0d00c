"""Intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts the plan's lineage, survives the loss of executors, and is
columnar, so later passes read only the columns they need. Tables staged within a
`scratch_scope` go when it ends, and `discard` drops one that nothing reads any more.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources import files

_local_root: str | None = None
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scratch_scopes", default=())


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; on local runs a new one if unset."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_root


def scratch_path(spark: SparkSession, name: str, *, outlives: bool = False) -> str:
    """A path nobody has used yet; within the innermost scope, or with ``outlives`` in the one around it."""
    scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    app = spark.sparkContext.applicationId
    folder = scopes[-1] if scopes else f"{scratch_root(spark)}/tallyhouse/{app}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Tables staged within the block are deleted when it ends, also after an error.

    A frame that is returned from the block must be staged with ``outlives``. The scope holds for the
    calling thread; work handed to other threads takes it along with ``contextvars.copy_context``.
    """
    folder = scratch_path(spark, name)
    token = _scopes.set((*_scopes.get(), folder))
    try:
        yield folder
    finally:
        _scopes.reset(token)
        files.delete(spark, folder)


def stage(df: DataFrame, name: str, *, outlives: bool = False) -> DataFrame:
    """Write the frame once and continue from the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name, outlives=outlives)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.scratch_path = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete the tables behind frames that `stage` returned; nothing may read them afterwards."""
    for df in staged:
        files.delete(df.sparkSession, df.scratch_path)
