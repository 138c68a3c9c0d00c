"""Column name clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame


def snake(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Trimmed lower snake case names; two columns meeting in one name is an error."""
    names = [snake(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after clean-up: {clashes}")
    return df.toDF(*names)
