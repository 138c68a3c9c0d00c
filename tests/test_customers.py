from datetime import date
from decimal import Decimal

from tallyhouse.operators import customers
from tests.support.samples import by, one

ORDER_SCHEMA = (
    "user_id string, order_id string, order_date date, restaurant_id string, is_loyalty boolean, "
    "gross_item_revenue decimal(14,2), option_revenue decimal(14,2), "
    "discount_amount decimal(14,2), net_order_revenue decimal(14,2)"
)


def orders(spark, *rows):
    """(user, order, day of January 2023, restaurant, net)"""
    return spark.createDataFrame(
        [
            (user, order, day and date(2023, 1, day), place, None, Decimal(net), Decimal(0), Decimal(0), Decimal(net))
            for user, order, day, place, net in rows
        ],
        ORDER_SCHEMA,
    )


SNAPSHOT_SCHEMA = (
    "user_id string, first_order_date date, latest_order_date date, customer_lifetime_days int, "
    "lifetime_order_count bigint, lifetime_net_revenue decimal(14,2), clv_quartile int, clv_tier string"
)


def snapshot(spark, rows):
    """(user, latest day of January 2023, orders, revenue)"""
    return spark.createDataFrame(
        [(u, date(2023, 1, 1), date(2023, 1, d), d, n, Decimal(m), 1, "low") for u, d, n, m in rows],
        SNAPSHOT_SCHEMA,
    )


def test_running_totals_per_customer(spark):
    df = orders(
        spark,
        ("u", "1", 1, "R1", 10),
        ("u", "2", 1, "R2", 5),
        ("u", "3", 4, "R1", 1),
        ("v", "4", 2, "R1", 7),
        (None, "5", 2, "R1", 99),
    )
    attributed = customers.customer_orders(df)
    assert attributed.count() == 4
    mart = by(customers.customer_daily_clv(df), "user_id", "order_date")
    first, last = mart["u", date(2023, 1, 1)], mart["u", date(2023, 1, 4)]
    assert (first["daily_order_count"], first["daily_restaurant_count"]) == (2, 2)
    assert (first["cumulative_order_count"], last["cumulative_order_count"]) == (2, 3)
    assert last["cumulative_net_revenue"] == Decimal("16.00")
    assert last["customer_lifetime_days"] == first["customer_lifetime_days"] == 4
    assert mart["v", date(2023, 1, 2)]["customer_lifetime_days"] == 1
    assert first["is_loyalty_customer_day"] is None
    # ascending by running value: v 7, u 15, u 16
    assert [mart[key]["clv_quartile"] for key in (("v", date(2023, 1, 2)), ("u", date(2023, 1, 1)), ("u", date(2023, 1, 4)))] == [1, 2, 3]
    assert [mart[key]["clv_tier"] for key in (("v", date(2023, 1, 2)), ("u", date(2023, 1, 4)))] == ["low", "medium_high"]
    summary = one(customers.customer_daily_clv_summary(customers.customer_daily_clv(df)))
    assert summary == {
        "row_count": 3,
        "distinct_customer_count": 2,
        "total_daily_net_revenue": Decimal("23.00"),
        "max_cumulative_net_revenue": Decimal("16.00"),
    }


def test_last_running_total_is_lifetime(spark):
    df = orders(spark, ("u", "1", 1, "R1", 10), ("u", "2", 9, "R1", 5), ("u", "3", None, "R1", 2))
    latest = one(customers.customer_clv_snapshot(customers.customer_daily_clv(df)))
    assert latest["latest_order_date"] == date(2023, 1, 9)
    # the undated order sorts first, so the newest dated row carries everything
    assert latest["lifetime_net_revenue"] == Decimal("17.00")
    assert latest["latest_daily_net_revenue"] == Decimal("5.00")


def test_snapshot_ranks_customers_not_days(spark):
    df = orders(
        spark,
        *[("big", f"b{day}", day, "R1", 100) for day in range(1, 10)],
        ("a", "1", 1, "R1", 1),
        ("b", "2", 1, "R1", 2),
        ("c", "3", 1, "R1", 3),
    )
    rows = by(customers.customer_clv_snapshot(customers.customer_daily_clv(df)), "user_id")
    assert {user: row["clv_tier"] for user, row in rows.items()} == {
        "a": "low",
        "b": "medium_low",
        "c": "medium_high",
        "big": "high",
    }
    counts = by(customers.clv_tier_counts(customers.customer_clv_snapshot(customers.customer_daily_clv(df))), "clv_tier")
    assert {tier: row["customer_count"] for tier, row in counts.items()} == dict.fromkeys(customers.CLV_TIERS, 1)


def test_tier_columns_of_older_snapshots_are_accepted(spark):
    old = snapshot(spark, [("u", 3, 1, 1)]).withColumnsRenamed(
        {"clv_quartile": "latest_clv_quartile", "clv_tier": "latest_clv_tier"}
    )
    row = one(customers.rfm_base(old))
    assert (row["clv_quartile"], row["clv_tier"], row["recency_days"]) == (1, "low", 0)


def test_every_segment(spark):
    base = snapshot(spark, [("u", 1, 1, 1)])
    scores = {
        (4, 4, 4): "champions",
        (3, 4, 4): "loyal_high_value",
        (4, 3, 3): "loyal_high_value",
        (4, 2, 4): "new_or_promising",
        (4, 1, 1): "new_or_promising",
        (2, 3, 3): "at_risk_high_value",
        (1, 4, 4): "at_risk_high_value",
        (2, 2, 4): "hibernating",
        (1, 1, 1): "hibernating",
        (3, 2, 2): "needs_attention",
        (2, 4, 2): "needs_attention",
        (4, 4, 2): "needs_attention",
    }
    rows = spark.createDataFrame([(*key,) for key in scores], "recency_score int, frequency_score int, monetary_score int")
    found = {tuple(row)[:3]: row[3] for row in rows.select("*", customers._segment()).collect()}
    assert found == scores
    assert base.count() == 1


def test_rfm_scores_and_counts(spark):
    rows = [("a", 1, 1, 10), ("b", 10, 2, 20), ("c", 20, 3, 30), ("d", 31, 4, 40)]
    mart = customers.customer_rfm(snapshot(spark, rows))
    found = by(mart, "user_id")
    assert {user: row["rfm_code"] for user, row in found.items()} == {"a": "111", "b": "222", "c": "333", "d": "444"}
    assert found["d"]["rfm_score"] == 12.0 and found["d"]["rfm_total_score"] == 12
    assert found["a"]["recency_days"] == 30
    assert {row["rfm_as_of_date"] for row in found.values()} == {date(2023, 1, 31)}
    counts = {row[0]: row[1] for row in customers.rfm_segment_counts(mart).collect()}
    assert counts == dict.fromkeys(customers.RFM_SEGMENTS, 0) | {"champions": 1, "loyal_high_value": 1, "hibernating": 2}


def test_no_row_is_ranked_in_one_task(spark):
    """The quartile label is a projection over the staged rows: no exchange at all."""
    df = orders(spark, *[(f"u{n}", str(n), 1 + n % 28, "R1", n) for n in range(50)])
    plan = customers.customer_daily_clv(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
