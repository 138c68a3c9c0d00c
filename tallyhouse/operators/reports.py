"""Analysis and validation reports over one mart each, described as data.

A report lists columns of its mart, or totals them, for each key if there are keys. Both
kinds may be put in order of a measure and cut to the first few rows; keys settle ties, so
a rerun gives the same list.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import top_rows
from tallyhouse.sources.layers import partition_filter

TOP = 10


class Listing(NamedTuple):
    mart: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    by: str | None = None  # falling; without it rows are in order of the keys
    most: int | None = None


class Totals(NamedTuple):
    mart: str
    totals: dict[str, tuple[str, str]]  # name -> kind of total, column
    keys: tuple[str, ...] = ()
    by: str | None = None
    most: int | None = None


def _total(kind: str, column: str) -> Column:
    match kind:
        case "rows":
            return F.count(F.lit(1))
        case "sum":
            return F.sum(column)
        case "distinct":
            return F.count_distinct(column)
        case "money mean":  # of daily averages, unweighted: not revenue over orders
            return F.avg(column).cast("decimal(14,2)")
    raise ValueError(f"unknown kind of total: {kind}")


_ROWS = ("rows", "*")
_SALES = {"total_orders": ("sum", "order_count"), "total_net_revenue": ("sum", "net_revenue")}
_ITEMS = {
    "total_line_items": ("sum", "line_item_count"),
    "total_item_quantity": ("sum", "total_item_quantity"),
    "total_net_revenue": ("sum", "net_revenue"),
}
_LIFETIME = ("sum", "lifetime_net_revenue")
_ITEM_LIST = ("net_revenue", "total_item_quantity", "line_item_count", "avg_net_revenue_per_line")

# The reports' names, marts, columns and lengths.
REPORTS: dict[str, Listing | Totals] = {
    "top_items": Listing("item_sales", ("item_category", "item_name"), _ITEM_LIST, "net_revenue", TOP),
    "top_restaurants": Totals(
        "restaurant_daily_sales",
        _SALES | {"avg_daily_aov": ("money mean", "avg_order_value")},
        ("restaurant_id",),
        "total_net_revenue",
        TOP,
    ),
    "daily_revenue_trend": Listing(
        "daily_sales", ("order_date",), ("order_count", "customer_count", "net_revenue", "avg_order_value")
    ),
    "customers_by_rfm_segment": Totals(
        "customer_rfm",
        {"customer_count": _ROWS, "segment_lifetime_net_revenue": _LIFETIME},
        ("rfm_segment",),
        "segment_lifetime_net_revenue",
    ),
    "top_options": Listing(
        "option_sales",
        ("option_group_name", "option_name"),
        ("option_revenue", "total_option_quantity", "option_row_count"),
        "option_revenue",
        TOP,
    ),
    "top_restaurant_items": Listing(
        "restaurant_item_sales",
        ("restaurant_id", "item_category", "item_name"),
        (*_ITEM_LIST, "avg_net_revenue_per_unit"),
        "net_revenue",
        TOP,
    ),
    "validate_daily_sales": Totals("daily_sales", _SALES),
    "validate_restaurant_daily_sales": Totals("restaurant_daily_sales", _SALES),
    "validate_clv_snapshot": Totals(
        "customer_clv_snapshot", {"customer_count": _ROWS, "total_lifetime_net_revenue": _LIFETIME}
    ),
    "validate_item_sales": Totals("item_sales", {"item_count": _ROWS} | _ITEMS),
    "validate_restaurant_item_sales": Totals("restaurant_item_sales", {"restaurant_item_count": _ROWS} | _ITEMS),
    "validate_option_sales": Totals(
        "option_sales",
        {
            "option_count": _ROWS,
            "total_option_rows": ("sum", "option_row_count"),
            "total_option_quantity": ("sum", "total_option_quantity"),
            "total_option_revenue": ("sum", "option_revenue"),
            "total_discount_amount": ("sum", "discount_amount"),
        },
    ),
    "validate_rfm_grain": Totals(
        "customer_rfm",
        {
            "rfm_row_count": _ROWS,
            "distinct_customer_count": ("distinct", "user_id"),
            "total_lifetime_net_revenue": _LIFETIME,
        },
    ),
}


def report(name: str, mart: DataFrame) -> DataFrame:
    """Run a report over one run of its mart."""
    spec = REPORTS[name]
    if isinstance(spec, Totals):
        rows = mart.groupBy(*spec.keys).agg(*[_total(*what).alias(out) for out, what in spec.totals.items()])
    else:
        rows = mart.select(*spec.keys, *spec.measures)
    return top_rows(rows, spec.by, spec.keys, spec.most) if spec.keys else rows


def report_on_tables(spark: SparkSession, database: str, name: str, ingest_date: str) -> DataFrame:
    """Run a report over registered tables, reading one date only."""
    mart = spark.table(f"{database}.{REPORTS[name].mart}")
    return report(name, partition_filter(mart, ingest_date))
