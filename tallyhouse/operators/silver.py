"""Cleaned layer: typed columns and derived flags. No step drops or adds rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import casts
from tallyhouse.functions.calendar import month_name
from tallyhouse.functions.casts import MONEY
from tallyhouse.functions.measures import rows
from tallyhouse.functions.names import normalize_column_names
from tallyhouse.schemas import OPTION_KEY


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Typed order lines with day, gross revenue and key flags."""
    df = normalize_column_names(raw)
    typed = df.select(
        casts.text(df, "app_name"),
        casts.text(df, "restaurant_id"),
        casts.timestamp(df, "creation_time_utc"),
        casts.text(df, "order_id"),
        casts.text(df, "user_id"),
        casts.text(df, "printed_card_number"),
        casts.boolean(df, "is_loyalty"),
        casts.text(df, "currency"),
        casts.text(df, "lineitem_id"),
        casts.text(df, "item_category"),
        casts.text(df, "item_name"),
        casts.price(df, "item_price"),
        casts.integer(df, "item_quantity"),
    )
    return typed.select(
        "*",
        F.to_date("creation_time_utc").alias("order_date"),
        (F.col("item_price") * F.col("item_quantity")).cast(MONEY).alias("gross_item_revenue"),
        (F.col("order_id").isNotNull() & F.col("lineitem_id").isNotNull()).alias(
            "is_valid_order_item_key"
        ),
        F.col("user_id").isNotNull().alias("has_user_id"),
    )


def order_items_measures() -> list[Column]:
    """Quality counts of cleaned lines, to aggregate or to observe while they are written."""
    return [
        F.count_if(~F.col("is_valid_order_item_key")).alias("invalid_key_count"),
        F.count_if(~F.col("has_user_id")).alias("missing_user_id_count"),
        F.count_if(F.col("creation_time_utc").isNull()).alias("invalid_timestamp_count"),
    ]


def order_items_quality(clean: DataFrame) -> DataFrame:
    return clean.agg(rows("row_count"), *order_items_measures())


def clean_order_item_options(raw: DataFrame) -> DataFrame:
    """Typed option rows. Repeats stay: a modifier may be ordered twice."""
    df = normalize_column_names(raw)
    typed = df.select(
        casts.text(df, "order_id"),
        casts.text(df, "lineitem_id"),
        casts.text(df, "option_group_name"),
        casts.text(df, "option_name"),
        casts.price(df, "option_price"),
        casts.integer(df, "option_quantity"),
    )
    revenue = (F.col("option_price") * F.col("option_quantity")).cast(MONEY)
    is_discount = F.col("option_price") < 0
    return typed.select(
        "*",
        revenue.alias("option_revenue"),
        is_discount.alias("is_discount"),
        F.when(is_discount, F.abs(revenue)).otherwise(F.lit(0).cast(MONEY)).alias("discount_amount"),
        (F.col("order_id").isNotNull() & F.col("lineitem_id").isNotNull()).alias(
            "is_valid_option_key"
        ),
        F.concat_ws("|", *OPTION_KEY).alias("candidate_option_key"),
    )


def options_measures() -> list[Column]:
    """Quality counts of cleaned options, to aggregate or to observe while they are written."""
    return [
        F.count_if(~F.col("is_valid_option_key")).alias("invalid_key_count"),
        F.count_if("is_discount").alias("discount_row_count"),
        F.count_if(F.col("option_price").isNull()).alias("null_option_price_count"),
        F.count_if(F.col("option_quantity").isNull()).alias("null_option_quantity_count"),
    ]


def options_quality(clean: DataFrame) -> DataFrame:
    return clean.agg(rows("row_count"), *options_measures())


def duplicate_option_keys(clean: DataFrame) -> DataFrame:
    """Repeated candidate keys: number of groups and of surplus rows."""
    groups = clean.groupBy(*OPTION_KEY).agg(rows("copies")).where("copies > 1")
    return groups.agg(
        rows("duplicate_key_groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_key_rows"),
    )


def clean_date_dim(raw: DataFrame) -> DataFrame:
    """Typed calendar; the key may be a date or text in either accepted format."""
    df = normalize_column_names(raw)
    typed = df.select(
        casts.day(df, "date_key"),
        casts.integer(df, "year"),
        casts.integer(df, "month"),
        casts.integer(df, "week"),
        casts.text(df, "day_of_week"),
        casts.boolean(df, "is_weekend"),
        casts.boolean(df, "is_holiday"),
        casts.text(df, "holiday_name"),
    )
    date_key = F.col("date_key")
    return typed.select(
        "*",
        F.dayofmonth(date_key).alias("day_of_month"),
        F.quarter(date_key).alias("quarter"),
        month_name(date_key).alias("month_name"),
        date_key.isNotNull().alias("is_valid_date_key"),
    )


def date_dim_quality(clean: DataFrame) -> DataFrame:
    """Row, bad-key and repeated-key counts from one grouping by date."""
    by_key = clean.groupBy("date_key").agg(rows("copies"))
    has_key = F.col("date_key").isNotNull()
    return by_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(~has_key, F.col("copies"))), F.lit(0)).alias(
            "invalid_date_key_count"
        ),
        F.count_if(has_key & (F.col("copies") > 1)).alias("duplicate_date_key_groups"),
    )
