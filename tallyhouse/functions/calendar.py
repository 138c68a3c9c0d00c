"""Calendar attributes derived from a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def derived_attributes(date: Column) -> dict[str, Column]:
    """What a calendar row would say about a day that has none. Weeks are ISO weeks."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "month_name": month_name(date),
        "week": F.weekofyear(date),
        "day_of_week": F.date_format(date, "EEEE"),
        "day_of_month": F.dayofmonth(date),
        "quarter": F.quarter(date),
        "is_weekend": F.dayofweek(date).isin(1, 7),
        "is_holiday": F.lit(False),
    }
