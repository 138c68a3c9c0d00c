"""Several distinct counts per group next to ordinary aggregates."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    """Distinct non-null values per group: ``{alias: column}``.

    Values of all columns go through one narrow shuffle as (group, column, value)
    rows. Repeats are dropped before it, and the values of one hot group spread
    over all tasks, so the second, per-group count only adds up small parts.
    """
    pairs = [
        F.struct(F.lit(number).alias("counted"), F.col(name).alias("value"))
        for number, name in enumerate(counted.values())
    ]
    values = df.select(*keys, F.inline(F.array(*pairs))).where("value is not null").distinct()
    return values.groupBy(*keys).agg(
        *[F.count_if(F.col("counted") == number).alias(name) for number, name in enumerate(counted)]
    )


def with_distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    counted: Mapping[str, str],
    measures: Sequence[Column],
) -> DataFrame:
    """``df.groupBy(keys).agg(measures)`` with distinct counts as further columns.

    With several ``count_distinct`` in one aggregation Spark copies every row,
    measures included, once per counted column. Here measures and counts are
    aggregated apart and joined per group. The input is read twice, so give a
    written table. A null group key matches itself.
    """
    measured = df.groupBy(*keys).agg(*measures)
    counts = distinct_counts(df, keys, counted).withColumnsRenamed({key: f"_{key}" for key in keys})
    same_group = [measured[key].eqNullSafe(counts[f"_{key}"]) for key in keys]
    joined = measured.join(counts, functools.reduce(Column.__and__, same_group), "left")
    # A group without any non-null value has no counts row.
    found = {name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in counted}
    return joined.drop(*[f"_{key}" for key in keys]).withColumns(found)
