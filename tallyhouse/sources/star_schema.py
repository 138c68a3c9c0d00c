"""The three order sources, derived from star-schema tables of order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.casts import PRICE


# Columns the sources are derived from; naming them saves a footer read per table.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_discount double, l_tax double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem")


def _line_id():
    parts = [F.col(name).cast("string") for name in ("l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("-", *parts)


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, with its order, part and customer where they are known.

    Orders come last and are met by the text id, so that the result is partitioned by ``order_id`` and the
    joins and groupings by order that follow need not move the lines again.
    """
    lines = _lines(spark, folder)
    orders = _table(spark, folder, "orders")
    parts = _table(spark, folder, "part")
    customers = _table(spark, folder, "customer")
    placed = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left").select(
        F.col("o_orderkey").cast("string").alias("placed_id"), "o_custkey", "o_orderdate", "c_mktsegment"
    )
    priced = lines.join(parts, lines["l_partkey"] == parts["p_partkey"], "left").withColumn(
        "order_id", F.col("l_orderkey").cast("string")
    )
    joined = priced.join(placed, F.col("order_id") == F.col("placed_id"), "left")
    order_key, customer = F.col("l_orderkey"), F.col("o_custkey").cast("string")
    return joined.select(
        F.lit("demo").alias("app_name"),
        F.concat(F.lit("R"), (order_key % 28).cast("string")).alias("restaurant_id"),
        F.col("o_orderdate").cast("timestamp").alias("creation_time_utc"),
        "order_id",
        F.when(order_key % 11 != 0, customer).alias("user_id"),
        F.when(order_key % 3 == 0, F.concat(F.lit("card-"), customer)).alias(
            "printed_card_number"
        ),
        F.when(order_key % 13 != 0, F.col("c_mktsegment") == "BUILDING").alias("is_loyalty"),
        F.when(order_key % 17 == 0, "EUR").otherwise("USD").alias("currency"),
        _line_id().alias("lineitem_id"),
        F.col("p_type").alias("item_category"),
        F.col("p_name").alias("item_name"),
        F.col("p_retailprice").cast(PRICE).alias("item_price"),
        F.col("l_quantity").cast("int").alias("item_quantity"),
    )


def order_item_options(spark: SparkSession, folder: str) -> DataFrame:
    """Up to three option rows per line (add-on, its repeat, discount) in one scan."""
    lines = _lines(spark, folder)
    taxed = F.col("l_tax") > 0
    lines = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        _line_id().alias("line"),
        (F.col("l_orderkey") % 97 == 0).alias("is_orphan"),
        F.concat(F.lit("Add-on "), F.col("l_returnflag")).alias("add_on"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tier"),
        F.round(F.col("l_discount") * 100).cast("int").alias("off"),
        (1 + F.col("l_linenumber") % 3).cast("int").alias("add_on_quantity"),
        taxed.alias("is_taxed"),
        (taxed & (F.col("l_linenumber") == 7) & (F.col("l_partkey") % 10 == 0)).alias("is_repeated"),
        (F.col("l_discount") > 0.055).alias("is_discounted"),
    )
    add_on = F.struct(
        F.when(F.col("is_orphan"), F.concat(F.lit("x"), "line")).otherwise(F.col("line")).alias("lineitem_id"),
        F.col("add_on").alias("option_group_name"),
        F.concat(F.lit("Tier "), F.col("tier").cast("string")).alias("option_name"),
        F.col("tier").cast(PRICE).alias("option_price"),
        F.col("add_on_quantity").alias("option_quantity"),
    )
    discount = F.struct(
        F.col("line").alias("lineitem_id"),
        F.lit("Discount").alias("option_group_name"),
        F.concat(F.lit("Off "), F.col("off").cast("string")).alias("option_name"),
        (-F.col("off")).cast(PRICE).alias("option_price"),
        F.lit(1).alias("option_quantity"),
    )
    per_line = F.array(
        F.when(F.col("is_taxed"), add_on),
        F.when(F.col("is_repeated"), add_on),
        F.when(F.col("is_discounted"), discount),
    )
    exploded = lines.select("order_id", F.explode(per_line).alias("option"))
    return exploded.where("option is not null").select("order_id", "option.*")


def date_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar of all order days, keyed by day-first text.

    The last day of each month is absent, so that sales meet days without an entry.
    """
    orders = _table(spark, folder, "orders")
    day = F.col("day")
    every_day = orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    days = every_day.where(day != F.last_day(day))
    christmas = (F.month(day) == 12) & (F.dayofmonth(day) == 25)
    return days.select(
        F.date_format(day, "dd-MM-yyyy").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        christmas.alias("is_holiday"),
        F.when(christmas, "Christmas Day").alias("holiday_name"),
    )
