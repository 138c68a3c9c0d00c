"""Files and folders of any store Spark reaches, through its own Hadoop file systems."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path itself."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if there is none."""
    system, where = _at(spark, path)
    return system.delete(where, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename within one file system; the new name must be free, its parent folder is made."""
    system, source = _at(spark, old)
    _, target = _at(spark, new)
    if system.exists(target):
        raise FileExistsError(new)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    """Full name, bytes and whether it is a folder, for each entry of a folder or for a file itself, by name."""
    system, where = _at(spark, path)
    return sorted((s.getPath().toString(), s.getLen(), s.isDirectory()) for s in system.listStatus(where))
