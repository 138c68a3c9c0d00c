"""Facts: option revenue rolled up to lines, lines rolled up to orders."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.casts import MONEY
from tallyhouse.functions.measures import money_sum, money_total, rows, total
from tallyhouse.schemas import LINE_KEY

ORDER_ATTRIBUTES = (
    "app_name",
    "restaurant_id",
    "order_date",
    "user_id",
    "printed_card_number",
    "currency",
)


def options_by_lineitem(options: DataFrame) -> DataFrame:
    """One row per line that has options, so that joining it cannot multiply lines."""
    return options.groupBy(*LINE_KEY).agg(
        money_sum("option_revenue"),
        money_sum("discount_amount"),
        rows("option_row_count"),
        F.lit(True).alias("has_options"),
        F.bool_or("is_discount").alias("has_discount"),
    )


def fact_order_line(order_items: DataFrame, line_options: DataFrame) -> DataFrame:
    """Every order line with its option money; lines without options get zeros.

    ``line_options`` is the output of :func:`options_by_lineitem`.

    The option side is already partitioned by the plain key, and a join reusing that
    partitioning could not be split when one key is hot (say, a third of all lines
    share a null order id). With its key as new text both sides are exchanged for the
    join alone, which lets adaptive execution split the hot partition of the line side.
    Lines that arrive partitioned by order id stay where they are, and only the options
    are exchanged.
    """
    sums = line_options.withColumnsRenamed({name: f"_{name}" for name in LINE_KEY})
    sums = sums.withColumns({f"_{name}": F.concat(f"_{name}", F.lit("")) for name in LINE_KEY})
    same_line = functools.reduce(Column.__and__, [order_items[name] == sums[f"_{name}"] for name in LINE_KEY])
    joined = order_items.join(sums, same_line, "left")
    no_money = F.lit(0).cast(MONEY)
    option_revenue = F.coalesce("option_revenue", no_money)
    return joined.select(
        "order_id",
        "lineitem_id",
        "app_name",
        "restaurant_id",
        "creation_time_utc",
        "order_date",
        "user_id",
        "printed_card_number",
        "is_loyalty",
        "currency",
        "item_category",
        "item_name",
        "item_price",
        "item_quantity",
        "gross_item_revenue",
        option_revenue.alias("option_revenue"),
        F.coalesce("discount_amount", no_money).alias("discount_amount"),
        F.coalesce("option_row_count", F.lit(0).cast("bigint")).alias("option_row_count"),
        F.coalesce("has_options", F.lit(False)).alias("has_options"),
        F.coalesce("has_discount", F.lit(False)).alias("has_discount"),
        "is_valid_order_item_key",
        "has_user_id",
        # Discounts are negative option revenue already; nothing more to subtract.
        (F.col("gross_item_revenue") + option_revenue).cast(MONEY).alias("net_line_revenue"),
    )


def unmatched_option_lines(order_items: DataFrame, line_options: DataFrame) -> DataFrame:
    """Rolled-up options whose line does not exist. A null key never matches."""
    line_keys = order_items.select(*LINE_KEY).distinct()
    return line_options.join(line_keys, list(LINE_KEY), "left_anti")


def line_measures(amount: Callable[..., Column] = money_total) -> list[Column]:
    """Totals of order lines, to aggregate or to observe while they are written."""
    return [
        rows("line_count"),
        F.count_if("has_options").alias("lines_with_options"),
        F.count_if("has_discount").alias("lines_with_discount"),
        amount("gross_item_revenue", "total_gross_item_revenue"),
        amount("option_revenue", "total_option_revenue"),
        amount("discount_amount", "total_discount_amount"),
        amount("net_line_revenue", "total_net_line_revenue"),
    ]


def fact_order_line_totals(lines: DataFrame) -> DataFrame:
    return lines.agg(*line_measures(money_sum))


def _earliest(name: str) -> Column:
    """Value on the earliest line that has one; the same on every run.

    Lines are ordered by time, then line id, then the value itself; nulls last.
    """
    time, line = F.col("creation_time_utc"), F.col("lineitem_id")
    ranked = F.struct(
        time.isNull().alias("no_time"),
        time.alias("time"),
        line.isNull().alias("no_line"),
        line.alias("line"),
        F.col(name).alias("value"),
    )
    return F.min(F.when(F.col(name).isNotNull(), ranked))["value"].alias(name)


def _order_columns(line_count: Column, distinct_lines: Column) -> list[Column]:
    return [
        *[_earliest(name) for name in ORDER_ATTRIBUTES],
        F.min("creation_time_utc").alias("order_created_at_utc"),
        line_count.alias("line_item_count"),
        distinct_lines.alias("distinct_line_item_count"),
        total("item_quantity", "total_item_quantity"),
        money_sum("gross_item_revenue"),
        money_sum("option_revenue"),
        money_sum("discount_amount"),
        money_sum("net_line_revenue", "net_order_revenue"),
        total("option_row_count"),
        F.bool_or("is_loyalty").alias("is_loyalty"),
        F.bool_or("has_options").alias("has_options"),
        F.bool_or("has_discount").alias("has_discount"),
        F.bool_or("has_user_id").alias("has_user_id"),
        F.bool_and("is_valid_order_item_key").alias("all_line_keys_valid"),
    ]


def _in_order(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "app_name",
        "restaurant_id",
        "order_created_at_utc",
        "order_date",
        "user_id",
        "printed_card_number",
        "currency",
        "line_item_count",
        "distinct_line_item_count",
        "total_item_quantity",
        "gross_item_revenue",
        "option_revenue",
        "discount_amount",
        "net_order_revenue",
        "option_row_count",
        "is_loyalty",
        "has_options",
        "has_discount",
        "has_user_id",
        "all_line_keys_valid",
    )


def fact_order(lines: DataFrame) -> DataFrame:
    """One row per order id; a null id forms one group of its own.

    The distinct line count makes Spark aggregate by (order, line) first, so even
    an order holding a large part of all lines is spread before it is merged.
    """
    counts = F.count(F.lit(1)), F.count_distinct("lineitem_id")
    return _in_order(lines.groupBy("order_id").agg(*_order_columns(*counts)))


def fact_order_of_written(lines: DataFrame) -> DataFrame:
    """:func:`fact_order` of a written table, which is read twice.

    Distinct lines are counted lines less the repeats of a line key, found by a second read of the keys alone and
    added to the lines as rows without values. Without a distinct count lines are combined before they are moved: written lines
    of an order mostly lie in one task, and each task sends one row for an order, however many lines it has.
    """
    copies = lines.where("lineitem_id is not null").groupBy(*LINE_KEY).agg(rows("copies")).where("copies > 1")
    repeats = copies.select("order_id", (F.col("copies") - 1).alias("_repeats"))
    marked = lines.withColumn("_line", F.lit(1)).unionByName(repeats, allowMissingColumns=True)
    distinct_lines = F.count("lineitem_id") - F.coalesce(F.sum("_repeats"), F.lit(0).cast("bigint"))
    return _in_order(marked.groupBy("order_id").agg(*_order_columns(F.count("_line"), distinct_lines)))


def order_measures(amount: Callable[..., Column] = money_total) -> list[Column]:
    """Totals of orders, to aggregate or to observe while they are written."""
    return [
        rows("order_count"),
        F.count_if("has_user_id").alias("orders_with_user_id"),
        F.count_if("has_options").alias("orders_with_options"),
        F.count_if("has_discount").alias("orders_with_discount"),
        F.count_if(~F.col("all_line_keys_valid")).alias("orders_with_invalid_line_keys"),
        amount("gross_item_revenue", "total_gross_item_revenue"),
        amount("option_revenue", "total_option_revenue"),
        amount("discount_amount", "total_discount_amount"),
        amount("net_order_revenue", "total_net_order_revenue"),
    ]


def fact_order_totals(orders: DataFrame) -> DataFrame:
    return orders.agg(*order_measures(money_sum))
