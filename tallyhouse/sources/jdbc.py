"""Tables of a relational source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    *,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column makes the read parallel.

    The bounds only decide how the column is cut into ranges. Rows outside them
    and rows with a null go to the outer ranges, so nothing is lost.
    """
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    ranged = {
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
    }
    given = {key: str(value) for key, value in ranged.items() if value is not None}
    if given and len(given) != len(ranged):
        missing = sorted(set(ranged) - set(given))
        raise ValueError(f"a parallel read also needs {missing}")
    return options | given


def read_jdbc_table(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """Full read of one table; arguments as in :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(*args, **kwargs)).load()
