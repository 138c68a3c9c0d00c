"""Layers as SQL tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.schemas import PARTITION


def register_tables(
    spark: SparkSession, database: str, bases: Mapping[str, str], location: str | None = None
) -> None:
    """Expose layer folders as external partitioned tables and find their dates.

    A table registered before is replaced, which picks up schema changes; the
    files stay where they are. A date written later needs :func:`add_date` only. ``location`` places the database itself elsewhere
    than in the session's warehouse folder.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, base in bases.items():
        columns = [
            f"`{field.name}` {field.dataType.simpleString()}"
            for field in spark.read.parquet(base).schema.fields
            if field.name != PARTITION
        ]
        table = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({', '.join(columns)}, {PARTITION} string) "
            f"USING parquet PARTITIONED BY ({PARTITION}) LOCATION '{base}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {table}")


def add_date(spark: SparkSession, database: str, tables: Iterable[str], ingest_date: str) -> None:
    """Make one more date of registered tables visible. Other dates are not listed, however many there are."""
    for name in tables:
        spark.sql(f"ALTER TABLE {database}.{name} ADD IF NOT EXISTS PARTITION ({PARTITION} = '{ingest_date}')")
        spark.catalog.refreshTable(f"{database}.{name}")


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select("tableName").withColumnRenamed(
        "tableName", "table_name"
    )
