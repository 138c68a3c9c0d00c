from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.operators import gold, sales, silver
from tallyhouse.operators.grouping import distinct_counts, with_distinct_counts
from tests.support import samples
from tests.support.samples import by, one


@pytest.fixture(scope="module")
def calendar(spark):
    raw = samples.dates(spark, "21-02-2023")
    return silver.clean_date_dim(raw)


def layers(spark, *item_rows, option_rows=()):
    items = silver.clean_order_items(samples.items(spark, *item_rows))
    options = silver.clean_order_item_options(samples.options(spark, *option_rows))
    lines = gold.fact_order_line(items, gold.options_by_lineitem(options))
    return lines, gold.fact_order(lines)


def test_daily_sales_with_and_without_calendar(spark, calendar):
    _, orders = layers(
        spark,
        {"order_id": "1"},
        {"order_id": "2", "user_id": None, "restaurant_id": "R2"},
        {"order_id": "3", "creation_time_utc": "2023-01-01T00:00:00Z", "item_price": "0.05"},
        {"order_id": "4", "creation_time_utc": "garbage"},
    )
    mart = by(sales.daily_sales(orders, calendar), "order_date")
    known = mart[date(2023, 2, 21)]
    assert (known["order_count"], known["customer_count"], known["restaurant_count"]) == (2, 1, 2)
    assert known["avg_order_value"] == Decimal("10.00")
    assert known["customer_identification_rate"] == Decimal("0.5000")
    assert (known["week"], known["day_of_week"], known["used_derived_date_attributes"]) == (8, "Tuesday", False)
    # 1 January 2023 is a Sunday in ISO week 52, and outside the calendar
    derived = mart[date(2023, 1, 1)]
    assert (derived["week"], derived["day_of_week"], derived["month_name"]) == (52, "Sunday", "January")
    assert derived["is_weekend"] is True and derived["is_holiday"] is False
    assert derived["holiday_name"] is None and derived["used_derived_date_attributes"] is True
    undated = mart[None]
    assert undated["order_count"] == 1 and undated["year"] is None and undated["is_weekend"] is None
    assert undated["is_holiday"] is False and undated["used_derived_date_attributes"] is True
    summary = one(sales.daily_sales_summary(sales.daily_sales(orders, calendar)))
    assert (summary["row_count"], summary["unmatched_date_count"]) == (3, 2)
    coverage = one(sales.date_coverage(sales.daily_sales_base(orders), calendar))
    assert coverage == {
        "min_order_date": date(2023, 1, 1),
        "max_order_date": date(2023, 2, 21),
        "min_date_key": date(2023, 2, 21),
        "max_date_key": date(2023, 2, 21),
        "unmatched_date_count": 2,
    }


def test_orders_without_id_count_as_none(spark, calendar):
    _, orders = layers(spark, {"order_id": None, "user_id": None})
    row = one(sales.daily_sales(orders, calendar))
    assert (row["order_count"], row["customer_count"]) == (0, 0)
    assert row["net_revenue"] == Decimal("10.00")
    assert row["avg_order_value"] is None and row["option_attach_rate"] is None


def test_restaurant_daily_sales_has_no_restaurant_count(spark, calendar):
    _, orders = layers(spark, {"order_id": "1"}, {"order_id": "2", "restaurant_id": None})
    mart = sales.restaurant_daily_sales(orders, calendar)
    assert "restaurant_count" not in mart.columns
    assert mart.columns[:2] == ["restaurant_id", "order_date"]
    assert set(by(mart, "restaurant_id")) == {"R1", None}


def test_item_sales_rounds_half_cents_up(spark):
    lines, _ = layers(
        spark,
        {"lineitem_id": "1", "item_price": "1.01", "user_id": None},
        {"lineitem_id": "2", "item_price": "1.02", "order_id": "o2"},
    )
    row = one(sales.item_sales(lines))
    assert row["avg_item_price"] == Decimal("1.02")
    assert row["avg_net_revenue_per_line"] == Decimal("1.02")
    assert (row["order_count"], row["restaurant_count"], row["customer_count"]) == (2, 1, 1)


def test_item_sales_without_quantity_has_no_unit_average(spark):
    lines, _ = layers(spark, {"item_quantity": "0"}, {"item_name": None, "item_category": None})
    rows = by(sales.item_sales(lines), "item_name")
    assert rows["Rice"]["avg_net_revenue_per_unit"] is None
    assert rows[None]["order_count"] == 1  # a null group counts its orders too


def test_option_sales_keeps_orphans_and_null_keys(spark):
    options = silver.clean_order_item_options(
        samples.options(
            spark,
            {},
            {"lineitem_id": "orphan", "option_quantity": "3"},
            {"order_id": None, "option_price": "-2.00"},
            {"option_name": "Free", "option_quantity": "0"},
        )
    )
    rows = by(sales.option_sales(options), "option_name")
    hot = rows["Hot"]
    assert (hot["option_row_count"], hot["order_count"], hot["line_item_count"]) == (3, 1, 3)
    assert hot["option_revenue"] == Decimal("2.00") and hot["discount_amount"] == Decimal("2.00")
    assert hot["discount_row_rate"] == Decimal("0.3333") and hot["valid_option_key_rate"] == Decimal("0.6667")
    assert rows["Free"]["avg_option_revenue_per_unit"] is None


def test_ties_at_the_top_go_by_group(spark):
    lines, _ = layers(spark, {"item_name": "b", "lineitem_id": "1"}, {"item_name": "a", "lineitem_id": "2"})
    assert one(sales.top_item(sales.item_sales(lines)))["item_name"] == "a"


def test_distinct_counts_equal_the_built_in(spark):
    from pyspark.sql import functions as F

    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") % 17).cast("string")).alias("group"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 101).cast("string")).alias("a"),
        (F.col("id") % 7).cast("string").alias("b"),
    )
    counted = {"n_a": "a", "n_b": "b"}
    ours = with_distinct_counts(df, ["group"], counted, [F.count(F.lit(1)).alias("n")])
    plain = df.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b")
    )
    assert by(ours, "group") == by(plain, "group")
    nothing = df.withColumn("a", F.lit(None).cast("string"))
    assert {row["n_a"] for row in with_distinct_counts(nothing, ["group"], {"n_a": "a"}, [F.count(F.lit(1)).alias("n")]).collect()} == {0}
    assert distinct_counts(nothing, ["group"], {"n_a": "a"}).count() == 0


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_results_do_not_depend_on_partitioning(spark, calendar, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [
            {"order_id": str(n % 40), "lineitem_id": str(n), "user_id": f"u{n % 7}", "item_price": f"{n}.{n % 100:02d}"}
            for n in range(200)
        ]
        lines, orders = layers(spark, *rows)
        assert one(gold.fact_order_line_totals(lines))["total_net_line_revenue"] == Decimal("19999.00")
        assert one(sales.daily_sales(orders, calendar))["customer_count"] == 7
        assert one(sales.item_sales(lines))["order_count"] == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
