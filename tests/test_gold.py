from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import checks, gold, silver
from tests.support import samples
from tests.support.samples import by, one


def facts(spark, item_rows, option_rows):
    items = silver.clean_order_items(samples.items(spark, *item_rows))
    options = silver.clean_order_item_options(samples.options(spark, *option_rows))
    line_options = gold.options_by_lineitem(options)
    return items, options, line_options, gold.fact_order_line(items, line_options)


def test_lines_with_no_one_and_many_options(spark):
    items, options, line_options, lines = facts(
        spark,
        [{"lineitem_id": name} for name in ("none", "one", "three", "discounts")],
        [
            {"lineitem_id": "one"},
            {"lineitem_id": "three"},
            {"lineitem_id": "three"},
            {"lineitem_id": "three", "option_price": "-0.50"},
            {"lineitem_id": "discounts", "option_price": "-3.00"},
            {"lineitem_id": "orphan", "option_price": "24.00"},
        ],
    )
    rows = by(lines, "lineitem_id")
    assert {
        key: (row["option_row_count"], row["option_revenue"], row["net_line_revenue"], row["has_options"], row["has_discount"])
        for key, row in rows.items()
    } == {
        "none": (0, Decimal("0.00"), Decimal("10.00"), False, False),
        "one": (1, Decimal("1.00"), Decimal("11.00"), True, False),
        "three": (3, Decimal("1.50"), Decimal("11.50"), True, True),
        # net is gross plus (negative) option revenue; the discount is not taken twice
        "discounts": (1, Decimal("-3.00"), Decimal("7.00"), True, True),
    }
    assert [row["lineitem_id"] for row in gold.unmatched_option_lines(items, line_options).collect()] == ["orphan"]
    gap = one(checks.option_revenue_gap(items, line_options))
    assert gap["option_revenue_gap"] == gap["unmatched_option_revenue"] == Decimal("24.00")
    assert gap["unmatched_option_lines"] == 1


def test_null_keys_never_match(spark):
    items, _, line_options, lines = facts(
        spark,
        [{"order_id": None}, {"lineitem_id": None}, {"order_id": None, "lineitem_id": None}],
        [{"order_id": None}, {"lineitem_id": None}, {"order_id": None, "lineitem_id": None}],
    )
    assert lines.count() == 3
    assert lines.where("has_options").count() == 0
    assert gold.unmatched_option_lines(items, line_options).count() == 3


def test_null_price_leaves_net_null_but_keeps_option_revenue(spark):
    _, _, _, lines = facts(spark, [{"item_price": None}], [{}])
    row = one(lines)
    assert row["gross_item_revenue"] is None and row["net_line_revenue"] is None
    assert row["option_revenue"] == Decimal("1.00")


def test_duplicate_lines_are_kept_and_reported(spark):
    items, _, line_options, lines = facts(spark, [{}, {}], [{}])
    assert lines.count() == 2
    report = by(checks.line_grain_gate(items, line_options, lines), "check_name")
    assert report["row count preserved"]["ok"]
    attached = report["option revenue attached once"]
    assert not attached["ok"] and attached["severity"] == "warn"


def test_order_takes_first_known_value_of_each_attribute(spark):
    _, _, _, lines = facts(
        spark,
        [
            {"lineitem_id": "b", "creation_time_utc": "2023-01-01T10:00:00Z", "user_id": None, "is_loyalty": None},
            {"lineitem_id": "a", "creation_time_utc": "2023-01-02T10:00:00Z", "user_id": "later", "is_loyalty": "false"},
            {"lineitem_id": "c", "creation_time_utc": "garbage", "user_id": "untimed", "restaurant_id": "R9"},
            {"lineitem_id": "b", "creation_time_utc": "2023-01-01T10:00:00Z", "user_id": None, "is_loyalty": "true"},
        ],
        [],
    )
    row = one(gold.fact_order(lines))
    assert row["user_id"] == "later" and row["restaurant_id"] == "R1"
    assert row["printed_card_number"] is None
    assert row["order_created_at_utc"] == datetime(2023, 1, 1, 10)
    assert (row["line_item_count"], row["distinct_line_item_count"]) == (4, 3)
    assert row["is_loyalty"] is True and row["has_user_id"] is True


def test_null_order_id_is_one_group_and_all_null_loyalty_stays_null(spark):
    _, _, _, lines = facts(
        spark,
        [{"order_id": None, "is_loyalty": None}, {"order_id": None, "is_loyalty": None}, {"lineitem_id": None}],
        [],
    )
    rows = by(gold.fact_order(lines), "order_id")
    assert rows[None]["line_item_count"] == 2 and rows[None]["is_loyalty"] is None
    assert not rows[None]["all_line_keys_valid"]
    assert rows["o1"]["distinct_line_item_count"] == 0
    totals = one(gold.fact_order_totals(gold.fact_order(lines)))
    assert totals["order_count"] == 2 and totals["orders_with_invalid_line_keys"] == 2


def test_a_money_overflow_fails(spark):
    _, _, _, lines = facts(
        spark,
        [
            {"lineitem_id": str(n), "item_price": "9999999999.99", "item_quantity": "90"}
            for n in range(3)
        ],
        [],
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        gold.fact_order(lines).collect()


def test_hot_line_key_is_split_by_the_join(spark):
    """A third of all lines share one key; the join spreads them over several tasks."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    template = samples.items(spark, {}).first().asDict()
    varied = {
        "order_id": F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).otherwise("hot"),
        "lineitem_id": F.when(F.col("id") < 0, "other").otherwise("l1"),
        "item_name": F.md5(F.col("id").cast("string")),
    }
    many = spark.range(30_000, numPartitions=8).select(
        *[varied.get(name, F.lit(value).cast("string")).alias(name) for name, value in template.items()]
    )
    option_rows = samples.options(spark, {"order_id": "hot"}, {"order_id": "1"}, {"order_id": "lost"})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items = silver.clean_order_items(many)
        line_options = gold.options_by_lineitem(silver.clean_order_item_options(option_rows))
        lines = gold.fact_order_line(items, line_options)
        totals = one(gold.fact_order_line_totals(lines))
        assert totals["line_count"] == 30_000 and totals["lines_with_options"] == 10_001
        collected = gold.fact_order_line(items, line_options)
        collected.collect()
        plan = collected._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
