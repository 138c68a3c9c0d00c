"""Null-on-failure casts: a dirty value becomes null and its row survives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType

PRICE = DecimalType(12, 2)
MONEY = DecimalType(14, 2)
RATE = DecimalType(14, 4)

DATE_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd")


def _type_of(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType


def text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def price(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast(PRICE).alias(name)


def boolean(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("boolean").alias(name)


def integer(df: DataFrame, name: str) -> Column:
    """Whole number; text such as ``2.0`` is cut to 2, which a direct cast refuses."""
    column = F.col(name)
    if isinstance(_type_of(df, name), StringType):
        column = column.try_cast(DecimalType(38, 10))
    return column.try_cast("int").alias(name)


def timestamp(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("timestamp").alias(name)


def day(df: DataFrame, name: str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Date from a date, a timestamp, or text in the default or a listed format."""
    column = F.col(name)
    if not isinstance(_type_of(df, name), StringType):
        return column.try_cast("date").alias(name)
    parsed = [F.try_to_date(column, fmt) for fmt in formats]
    return F.coalesce(column.try_cast("date"), *parsed).alias(name)
