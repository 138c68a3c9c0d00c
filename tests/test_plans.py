"""Plan shapes over written layers, with broadcast joins off as for large data."""

from __future__ import annotations

import re

import pytest

from tallyhouse.operators import customers, gold, profile, sales
from tallyhouse.plans.layers import run_layers
from tests.support import samples


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    items = [{"order_id": f"o{n}", "lineitem_id": f"l{n}", "user_id": f"u{n % 5}"} for n in range(20)]
    sources = {
        "order_items": samples.items(spark, *items),
        "order_item_options": samples.options(spark, {"order_id": "o3", "lineitem_id": "l3"}),
        "date_dim": samples.dates(spark, "21-02-2023"),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    layers = run_layers(spark, sources, str(tmp_path_factory.mktemp("run")), "2023-05-01")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield layers
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def built(run):
    options = gold.options_by_lineitem(run["order_item_options_clean"])
    orders, lines = run["fact_order"], run["fact_order_line"]
    spend = customers.daily_customer_spend(customers.customer_orders(orders))
    return {
        "fact_order_line": gold.fact_order_line(run["order_items_clean"], options),
        "unmatched": gold.unmatched_option_lines(run["order_items_clean"], options),
        "fact_order": gold.fact_order(lines),
        "customer_cumulative": customers.customer_cumulative(spend),
        "customer_daily_clv": customers.customer_daily_clv(orders),
        "customer_clv_snapshot": customers.customer_clv_snapshot(run["customer_daily_clv"]),
        "customer_rfm": customers.customer_rfm(run["customer_clv_snapshot"]),
        "daily_sales": sales.daily_sales(orders, run["date_dim_clean"]),
        "restaurant_daily_sales": sales.restaurant_daily_sales(orders, run["date_dim_clean"]),
        "item_sales": sales.item_sales(lines),
        "restaurant_item_sales": sales.restaurant_item_sales(lines),
        "option_sales": sales.option_sales(run["order_item_options_clean"]),
        "column_profile": profile.column_profile(run["order_items"]),
    }


def test_no_dataset_passes_through_one_task_or_a_row_copying_plan(run):
    for name, df in built(run).items():
        main = re.split(r"Subquery|\(\d+\) Subqueries", plan(df))[0]
        assert "SinglePartition" not in main, (name, main)
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
            assert operator not in main, (name, operator, main)


def test_filters_and_columns_reach_the_scan(run):
    text = plan(customers.customer_orders(run["fact_order"]).select("user_id", "net_order_revenue"))
    assert "PushedFilters: [IsNotNull(user_id)]" in text
    assert "ReadSchema: struct<user_id:string,net_order_revenue:decimal(14,2)>" in text


def test_hot_groups_are_combined_before_they_are_moved(run):
    """Every exchange into an aggregation is fed by a partial one."""
    text = plan(sales.item_sales(run["fact_order_line"]))
    aggregated = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", text)
    assert any("counted" in keys and "value" in keys for keys in aggregated)
    assert "partial_sum" in text


def test_orders_are_merged_by_line_before_by_order(run):
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(gold.fact_order(run["fact_order_line"])))
    assert [re.sub(r"#\d+", "", keys) for keys in exchanges] == ["order_id, 8", "order_id, lineitem_id, 8"]


def test_profiles_read_each_file_once(run):
    items = run["order_items"]
    for report in (
        profile.data_quality_report({profile.ITEMS: items}),
        profile.profile_columns(profile.ITEMS, items),
        profile.profile_summary(profile.ITEMS, items),
    ):
        assert plan(report).count("FileScan parquet") == 1


def test_profiles_move_hashes_and_no_cells(run):
    text = plan(profile.profile_summary(profile.ITEMS, run["order_items"]))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert [re.sub(r"#\d+L?", "", k) for k in keys] == ["position, 8", "position, is_null, h1, h2, 8"]
    assert "SortAggregate" not in text and not re.search(r"cast\(\w+#\d+ as string\)", text.split("Exchange hashpartitioning")[-1])
