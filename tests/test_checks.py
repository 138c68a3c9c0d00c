from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import checks, gold, sales, silver
from tallyhouse.operators.checks import GateError, enforce
from tests.support import samples
from tests.support.samples import by


@pytest.fixture(scope="module")
def built(spark):
    items = silver.clean_order_items(
        samples.items(spark, {}, {"order_id": "o2", "item_name": "Beans"}, {"order_id": "o3"})
    )
    options = silver.clean_order_item_options(samples.options(spark, {}, {"order_id": "lost"}))
    dates = silver.clean_date_dim(samples.dates(spark, "21-02-2023"))
    lines = gold.fact_order_line(items, gold.options_by_lineitem(options))
    return {"items": items, "options": options, "dates": dates, "lines": lines, "orders": gold.fact_order(lines)}


def failed(report):
    return {row["check_name"] for row in report.collect() if not row["ok"]}


def test_good_marts_pass(built):
    mart = sales.daily_sales(built["orders"], built["dates"])
    report = checks.daily_sales_gate(built["orders"], built["dates"], mart)
    assert failed(report) == set()
    assert len(enforce(report)) == 6


def test_a_changed_total_fails(built):
    mart = sales.item_sales(built["lines"]).withColumn("net_revenue", F.col("net_revenue") + 1)
    report = checks.item_sales_gate(built["lines"], mart)
    assert failed(report) == {"net_revenue preserved"}
    with pytest.raises(GateError, match="item_sales: net_revenue preserved: expected 31.00, got 33.00"):
        enforce(report)


def test_a_dropped_row_fails(built):
    mart = sales.item_sales(built["lines"]).where("item_name <> 'Beans'")
    assert failed(checks.item_sales_gate(built["lines"], mart)) == {
        "net_revenue preserved", "line_item_count preserved", "item_quantity preserved",
    }
    assert failed(checks.row_count_gate("items", built["items"], built["items"].limit(2))) == {"row count preserved"}


def test_a_repeated_grain_fails(built):
    orders = built["orders"]
    assert failed(checks.order_grain_gate(built["lines"], orders.unionByName(orders))) == {"grain is unique"}
    assert failed(checks.order_grain_gate(built["lines"], orders)) == set()


def test_an_empty_mart_fails(built):
    empty = built["orders"].where("false")
    assert "target is not empty" in failed(checks.order_grain_gate(built["lines"], empty))
    mart = sales.option_sales(built["options"].where("false"))
    report = checks.option_sales_gate(built["options"].where("false"), mart)
    assert failed(report) == {"source is not empty", "target is not empty"}


def test_a_repeated_calendar_day_fails_before_and_after_the_join(built):
    dates = built["dates"].unionByName(built["dates"])
    mart = sales.daily_sales(built["orders"], dates)
    assert failed(checks.daily_sales_gate(built["orders"], dates, mart)) == {
        "date_dim keys are unique", "net_revenue preserved",
    }


def test_days_outside_the_calendar_only_warn(built):
    dates = built["dates"].withColumn("date_key", F.date_add("date_key", 1))
    mart = sales.restaurant_daily_sales(built["orders"], dates)
    report = checks.restaurant_daily_sales_gate(built["orders"], dates, mart)
    assert failed(report) == {"all days are in date_dim"}
    enforce(report)


def test_reconciliation_lists_every_metric(spark, built):
    from tallyhouse.operators import customers

    daily = customers.customer_daily_clv(built["orders"])
    snapshot = customers.customer_clv_snapshot(daily)
    layers = {
        "fact_order_line": built["lines"],
        "fact_order": built["orders"],
        "order_item_options_clean": built["options"],
        "daily_sales": sales.daily_sales(built["orders"], built["dates"]),
        "restaurant_daily_sales": sales.restaurant_daily_sales(built["orders"], built["dates"]),
        "item_sales": sales.item_sales(built["lines"]),
        "restaurant_item_sales": sales.restaurant_item_sales(built["lines"]),
        "customer_clv_snapshot": snapshot,
        "customer_rfm": customers.customer_rfm(snapshot),
        "option_sales": sales.option_sales(built["options"]),
    }
    table = by(checks.reconcile_marts(layers), "mart", "metric")
    assert len(table) == 17 and all(row["is_match"] for row in table.values())
    assert table["daily_sales", "net_revenue"]["mart_total"] == Decimal("31.00")
    assert table["option_sales", "option_revenue"]["source_total"] == Decimal("2.00")
