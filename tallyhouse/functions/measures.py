"""Aggregate and ratio expressions shared by facts, marts and checks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.casts import MONEY, RATE


def money_sum(name: str, alias: str | None = None) -> Column:
    """Exact total of a column with two decimals, back at money width; an overflow fails under ANSI."""
    return _cents_sum(name).cast(MONEY).alias(alias or name)


def money_total(name: str, alias: str | None = None) -> Column:
    """Like :func:`money_sum` for totals over whole tables, which may outgrow the width of one amount."""
    return _cents_sum(name).alias(alias or name)


def _cents_sum(name: str) -> Column:
    """Cents added as whole numbers: cheaper to add, sort and move than the 24 digits Spark gives a total of money."""
    cents = F.sum((F.col(name) * 100).cast("bigint"))
    return cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def total(name: str, alias: str | None = None) -> Column:
    return F.sum(name).alias(alias or name)


def rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def distinct(name: str, alias: str) -> Column:
    return F.count_distinct(name).alias(alias)


def true_count(condition: Column | str, alias: str) -> Column:
    """Rows where the flag holds; null over a group whose flags are all null."""
    flag = F.col(condition) if isinstance(condition, str) else condition
    return F.sum(flag.cast("int")).alias(alias)


def per(numerator: str, denominator: str, alias: str) -> Column:
    """Average per unit at money scale; null when there is nothing to divide by."""
    return F.try_divide(F.col(numerator), F.col(denominator)).cast(MONEY).alias(alias)


def share(numerator: str, denominator: str, alias: str) -> Column:
    """Rate at four decimals; null when there is nothing to divide by."""
    return F.try_divide(F.col(numerator), F.col(denominator)).cast(RATE).alias(alias)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, exact, rounded half up."""
    exact = F.try_divide((part * 100).cast("decimal(20,0)"), whole.cast("decimal(20,0)"))
    return exact.cast(f"decimal({digits + 5},{digits})")
