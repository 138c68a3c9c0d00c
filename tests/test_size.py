"""What keeps large tables cheap, and totals that outgrow the width of one amount."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.casts import MONEY
from tallyhouse.functions.measures import money_sum, money_total
from tallyhouse.operators import checks, gold, sales, silver
from tallyhouse.plans import queries
from tallyhouse.plans.queries import MART_COLUMNS, Frames
from tallyhouse.sources.scratch import stage
from tests.support import samples
from tests.support.samples import one
from tests.test_partitioning import plan_of, tables


def money(spark, *values):
    return spark.createDataFrame([(value and Decimal(value),) for value in values], "v decimal(14,2)")


def test_sums_of_money_are_exact(spark):
    amounts = money(spark, "999999999999.99", "-999999999999.98", "0.29", None, "-0.01")
    result = amounts.agg(money_sum("v", "total"), money_total("v", "wide"))
    assert result.schema["total"].dataType == MONEY
    assert one(result) == {"total": Decimal("0.29"), "wide": Decimal("0.29")}
    assert one(money(spark, None).agg(money_sum("v", "total")))["total"] is None


def test_only_totals_outgrow_the_width_of_money(spark):
    amounts = money(spark, "999999999999.99", "999999999999.99")
    assert one(amounts.agg(money_total("v")))["v"] == Decimal("1999999999999.98")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        amounts.agg(money_sum("v")).collect()


def test_sums_of_money_are_added_as_whole_cents(spark):
    """Spark's own total of money has 24 digits, which are objects in every step of an aggregation."""
    plan = plan_of(money(spark, "1.00").groupBy(F.lit(1)).agg(money_sum("v")))
    assert "as bigint" in plan, plan


def test_gates_hold_totals_beyond_the_width_of_money(spark):
    rows = [
        {"order_id": f"o{n}", "item_name": f"i{n}", "item_price": "9999999999.99", "item_quantity": "90"} for n in range(3)
    ]
    items = silver.clean_order_items(samples.items(spark, *rows))
    options = silver.clean_order_item_options(samples.options(spark, {"order_id": "o0"}))
    lines = gold.fact_order_line(items, gold.options_by_lineitem(options))
    report = checks.item_sales_gate(lines, sales.item_sales(lines)).collect()
    assert all(row["ok"] for row in report)
    assert one(lines.agg(*gold.line_measures()))["total_gross_item_revenue"] == Decimal("2699999999997.30")
    orders = gold.fact_order(lines)
    assert one(orders.agg(*gold.order_measures()))["order_count"] == 3


def test_tables_staged_for_marts_hold_what_is_read(spark, tmp_path):
    folder = tables(spark, tmp_path, F.col("id") / 4, lines=400)
    shared = Frames(spark, folder, shared=MART_COLUMNS, columns=MART_COLUMNS)
    assert shared.lines.columns == list(MART_COLUMNS["fact_order_line"])
    assert shared.orders.columns == list(MART_COLUMNS["fact_order"])
    assert "candidate_option_key" not in shared.options.columns
    assert Frames(spark, folder).written_orders.columns == shared.orders.columns
    whole = Frames(spark, folder)
    for name in ("item_sales", "daily_sales", "option_sales", "customer_clv_snapshot"):
        assert sorted(map(str, shared.mart(name).collect())) == sorted(map(str, whole.mart(name).collect()))
    assert {"printed_card_number", "currency"} <= set(whole.orders.columns)


@pytest.mark.parametrize("query", ["show_tables", "gate_report", "reconcile_marts"])
def test_what_several_marts_are_built_from_is_built_once(spark, tmp_path, monkeypatch, query):
    """Options are rolled up once for both facts, and customers ranked once for snapshot and segments."""
    folder = tables(spark, tmp_path, F.col("id") / 4, lines=400)
    calls = []
    for module, name in ((queries.gold, "options_by_lineitem"), (queries.customers, "customer_latest_row")):
        build = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, build=build, name=name: calls.append(name) or build(df))
    staged = []
    monkeypatch.setattr(queries, "stage", lambda df, name: staged.append(name) or stage(df, name))
    assert queries.QUERIES[query](spark, folder).count() > 0
    assert sorted(calls) == ["customer_latest_row", "options_by_lineitem"]
    assert {"options_by_lineitem", "customer_clv_snapshot"} <= set(staged)
    assert len(staged) == len(set(staged))


def test_a_snapshot_from_staged_customer_days_is_the_same(spark, tmp_path):
    folder = tables(spark, tmp_path, F.col("id") / 4, lines=400)
    shared, whole = Frames(spark, folder, shared=(*queries.SHARED, "customer_daily_clv")), Frames(spark, folder)
    for name in ("customer_daily_clv", "customer_clv_snapshot", "customer_rfm"):
        assert shared.mart(name).schema.simpleString() == whole.mart(name).schema.simpleString()
        assert sorted(map(str, shared.mart(name).collect())) == sorted(map(str, whole.mart(name).collect()))
