"""Sales marts: by day, by location and day, by item, by option."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import derived_attributes
from tallyhouse.functions.casts import MONEY
from tallyhouse.functions.measures import (
    distinct,
    money_sum,
    per,
    rows,
    share,
    total,
    true_count,
)
from tallyhouse.operators.grouping import with_distinct_counts
from tallyhouse.operators.ranking import top_rows

# Order of the measure columns in both daily marts.
DAILY_MEASURES = (
    "order_count",
    "customer_count",
    "restaurant_count",
    "line_item_count",
    "distinct_line_item_count",
    "total_item_quantity",
    "gross_item_revenue",
    "option_revenue",
    "discount_amount",
    "net_revenue",
    "avg_order_value",
    "avg_items_per_order",
    "option_row_count",
    "orders_with_options",
    "orders_with_discount",
    "option_attach_rate",
    "orders_with_user_id",
    "customer_identification_rate",
    "orders_with_invalid_line_keys",
)

# Order of the measure columns in both item marts.
ITEM_MEASURES = (
    "order_count",
    "restaurant_count",
    "line_item_count",
    "total_item_quantity",
    "avg_item_price",
    "min_item_price",
    "max_item_price",
    "gross_item_revenue",
    "option_revenue",
    "discount_amount",
    "net_revenue",
    "option_row_count",
    "line_items_with_options",
    "line_items_with_discount",
    "customer_count",
    "avg_net_revenue_per_line",
    "avg_net_revenue_per_unit",
    "option_attach_rate",
    "discount_attach_rate",
)


def _sales_by(orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = {"customer_count": "user_id", "restaurant_count": "restaurant_id"}
    counted = {alias: name for alias, name in counted.items() if name not in keys}
    measures = [
        # order_id is unique in the order fact: counting it is counting distinct orders.
        F.count("order_id").alias("order_count"),
        total("line_item_count"),
        total("distinct_line_item_count"),
        total("total_item_quantity"),
        money_sum("gross_item_revenue"),
        money_sum("option_revenue"),
        money_sum("discount_amount"),
        money_sum("net_order_revenue", "net_revenue"),
        total("option_row_count"),
        true_count("has_options", "orders_with_options"),
        true_count("has_discount", "orders_with_discount"),
        true_count("has_user_id", "orders_with_user_id"),
        true_count(~F.col("all_line_keys_valid"), "orders_with_invalid_line_keys"),
    ]
    rated = with_distinct_counts(orders, keys, counted, measures).select(
        "*",
        per("net_revenue", "order_count", "avg_order_value"),
        per("total_item_quantity", "order_count", "avg_items_per_order"),
        share("orders_with_options", "order_count", "option_attach_rate"),
        share("orders_with_user_id", "order_count", "customer_identification_rate"),
    )
    return rated.select(*keys, *[name for name in DAILY_MEASURES if name in rated.columns])


def daily_sales_base(orders: DataFrame) -> DataFrame:
    return _sales_by(orders, ["order_date"])


def restaurant_daily_sales_base(orders: DataFrame) -> DataFrame:
    return _sales_by(orders, ["restaurant_id", "order_date"])


def with_calendar(sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Add calendar attributes; days outside the calendar get derived ones.

    Sales are aggregated before this join, so both sides are calendar sized per
    location and Spark broadcasts the calendar when it measures it as small.
    """
    derived = derived_attributes(F.col("order_date"))
    calendar = date_dim.select(
        "date_key",
        F.col("holiday_name"),
        *[F.col(name).alias(f"dim_{name}") for name in derived],
    )
    joined = sales.join(calendar, sales["order_date"] == calendar["date_key"], "left")
    keys = [name for name in ("restaurant_id", "order_date") if name in sales.columns]
    return joined.select(
        *keys,
        *[F.coalesce(F.col(f"dim_{name}"), value).alias(name) for name, value in derived.items()],
        "holiday_name",
        *[name for name in DAILY_MEASURES if name in sales.columns],
        F.col("date_key").isNull().alias("used_derived_date_attributes"),
    )


def daily_sales(orders: DataFrame, date_dim: DataFrame) -> DataFrame:
    return with_calendar(daily_sales_base(orders), date_dim)


def restaurant_daily_sales(orders: DataFrame, date_dim: DataFrame) -> DataFrame:
    return with_calendar(restaurant_daily_sales_base(orders), date_dim)


def date_coverage(sales_base: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Date span of sales and calendar, and sales rows the calendar lacks."""
    calendar = date_dim.select(F.col("date_key").alias("order_date"), F.lit(True).alias("in_dim"))
    known = calendar.distinct()
    checked = sales_base.select("order_date").join(known, "order_date", "left")
    span = checked.agg(
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        F.count_if(F.col("in_dim").isNull()).alias("unmatched_date_count"),
    )
    dim_span = date_dim.agg(F.struct(F.min("date_key").alias("low"), F.max("date_key").alias("high")))
    return span.withColumn("dim", dim_span.scalar()).select(
        "min_order_date",
        "max_order_date",
        F.col("dim.low").alias("min_date_key"),
        F.col("dim.high").alias("max_date_key"),
        "unmatched_date_count",
    )


def daily_sales_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        total("order_count", "total_order_count"),
        money_sum("net_revenue", "total_net_revenue"),
        F.max("net_revenue").alias("max_daily_net_revenue"),
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        F.count_if("used_derived_date_attributes").alias("unmatched_date_count"),
    )


def restaurant_daily_sales_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        distinct("restaurant_id", "restaurant_count"),
        total("order_count", "total_order_count"),
        money_sum("net_revenue", "total_net_revenue"),
        F.max("net_revenue").alias("max_restaurant_daily_net_revenue"),
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        F.count_if("used_derived_date_attributes").alias("unmatched_date_count"),
    )


def _items_by(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = {
        "order_count": "order_id",
        "restaurant_count": "restaurant_id",
        "customer_count": "user_id",
    }
    counted = {alias: name for alias, name in counted.items() if name not in keys}
    measures = [
        rows("line_item_count"),
        total("item_quantity", "total_item_quantity"),
        F.avg("item_price").cast(MONEY).alias("avg_item_price"),
        F.min("item_price").cast(MONEY).alias("min_item_price"),
        F.max("item_price").cast(MONEY).alias("max_item_price"),
        money_sum("gross_item_revenue"),
        money_sum("option_revenue"),
        money_sum("discount_amount"),
        money_sum("net_line_revenue", "net_revenue"),
        total("option_row_count"),
        true_count("has_options", "line_items_with_options"),
        true_count("has_discount", "line_items_with_discount"),
    ]
    rated = with_distinct_counts(lines, keys, counted, measures).select(
        "*",
        per("net_revenue", "line_item_count", "avg_net_revenue_per_line"),
        per("net_revenue", "total_item_quantity", "avg_net_revenue_per_unit"),
        share("line_items_with_options", "line_item_count", "option_attach_rate"),
        share("line_items_with_discount", "line_item_count", "discount_attach_rate"),
    )
    return rated.select(*keys, *[name for name in ITEM_MEASURES if name in rated.columns])


def item_sales(lines: DataFrame) -> DataFrame:
    return _items_by(lines, ["item_category", "item_name"])


def restaurant_item_sales(lines: DataFrame) -> DataFrame:
    return _items_by(lines, ["restaurant_id", "item_category", "item_name"])


def item_sales_summary(mart: DataFrame) -> DataFrame:
    """Totals and number of distinct groups; the mart is one row per group."""
    return _group_summary(mart, ["item_category", "item_name"])


def restaurant_item_sales_summary(mart: DataFrame) -> DataFrame:
    keys = ["restaurant_id", "item_category", "item_name"]
    return _group_summary(mart, keys, distinct("restaurant_id", "restaurant_count"))


def _group_summary(mart: DataFrame, keys: Sequence[str], *extra) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        F.count_distinct(F.struct(*keys)).alias("distinct_group_count"),
        *extra,
        total("line_item_count", "total_line_items"),
        total("total_item_quantity", "total_item_quantity"),
        money_sum("net_revenue", "total_net_revenue"),
    )


def top_item(mart: DataFrame) -> DataFrame:
    keys = ["item_category", "item_name"]
    return top_rows(mart, "net_revenue", keys).select(*keys, "net_revenue", "line_item_count")


def top_restaurant_item(mart: DataFrame) -> DataFrame:
    keys = ["restaurant_id", "item_category", "item_name"]
    return top_rows(mart, "net_revenue", keys).select(*keys, "net_revenue", "line_item_count")


OPTION_GROUP = ("option_group_name", "option_name")
OPTION_MEASURES = (
    "option_row_count",
    "order_count",
    "line_item_count",
    "total_option_quantity",
    "avg_option_price",
    "min_option_price",
    "max_option_price",
    "option_revenue",
    "discount_amount",
    "discount_row_count",
    "valid_option_key_row_count",
    "avg_option_revenue_per_row",
    "avg_option_revenue_per_unit",
    "discount_row_rate",
    "valid_option_key_rate",
)


def option_sales(options: DataFrame) -> DataFrame:
    """Option performance from all cleaned option rows, orphans included."""
    keyed = options.withColumn("order_line_key", F.concat_ws("||", "order_id", "lineitem_id"))
    measures = [
        rows("option_row_count"),
        total("option_quantity", "total_option_quantity"),
        F.avg("option_price").cast(MONEY).alias("avg_option_price"),
        F.min("option_price").cast(MONEY).alias("min_option_price"),
        F.max("option_price").cast(MONEY).alias("max_option_price"),
        money_sum("option_revenue"),
        money_sum("discount_amount"),
        true_count("is_discount", "discount_row_count"),
        true_count("is_valid_option_key", "valid_option_key_row_count"),
    ]
    counted = {"order_count": "order_id", "line_item_count": "order_line_key"}
    rated = with_distinct_counts(keyed, OPTION_GROUP, counted, measures).select(
        "*",
        per("option_revenue", "option_row_count", "avg_option_revenue_per_row"),
        per("option_revenue", "total_option_quantity", "avg_option_revenue_per_unit"),
        share("discount_row_count", "option_row_count", "discount_row_rate"),
        share("valid_option_key_row_count", "option_row_count", "valid_option_key_rate"),
    )
    return rated.select(*OPTION_GROUP, *OPTION_MEASURES)


def option_sales_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        F.count_distinct(F.struct(*OPTION_GROUP)).alias("distinct_group_count"),
        total("option_row_count", "total_option_rows"),
        total("total_option_quantity", "total_option_quantity"),
        money_sum("option_revenue", "total_option_revenue"),
        money_sum("discount_amount", "total_discount_amount"),
    )


def top_option_by_revenue(mart: DataFrame) -> DataFrame:
    return top_rows(mart, "option_revenue", OPTION_GROUP).select(
        *OPTION_GROUP, "option_revenue", "total_option_quantity"
    )


def top_option_by_quantity(mart: DataFrame) -> DataFrame:
    return top_rows(mart, "total_option_quantity", OPTION_GROUP).select(
        *OPTION_GROUP, "total_option_quantity", "option_revenue"
    )
