from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import gold, ranking, silver, trends
from tests.support import samples
from tests.support.samples import by

ORDERS = (
    "user_id string, order_id string, order_date date, restaurant_id string, is_loyalty boolean, "
    "gross_item_revenue decimal(14,2), option_revenue decimal(14,2), discount_amount decimal(14,2), net_order_revenue decimal(14,2)"
)


def orders(spark, *rows):
    """(user, day, net) or (user, day, net, location, loyalty)."""
    full = []
    for n, (user, day, net, *rest) in enumerate(rows):
        location, loyalty = (*rest, "R1", None)[:2] if len(rest) < 2 else rest
        full.append((user, f"o{n}", day, location, loyalty, Decimal(net), Decimal(0), Decimal(0), Decimal(net)))
    return spark.createDataFrame(full, ORDERS)


def lines(spark, item_rows, option_rows=()):
    items = silver.clean_order_items(samples.items(spark, *item_rows))
    options = silver.clean_order_item_options(samples.options(spark, *option_rows))
    return gold.fact_order_line(items, gold.options_by_lineitem(options))


def test_trends_have_totals_at_every_level_and_the_year_before(spark):
    rows = [
        {"lineitem_id": "a", "creation_time_utc": "2022-02-21 10:00:00", "item_price": "8.00"},
        {"lineitem_id": "b", "creation_time_utc": "2023-02-20 10:00:00", "item_price": "10.00"},
        {"lineitem_id": "c", "creation_time_utc": "2023-02-21 10:00:00", "item_price": "2.00", "item_category": "Drinks"},
        {"lineitem_id": "d", "creation_time_utc": None, "item_price": "1.00"},
        {"lineitem_id": "e", "creation_time_utc": "2025-02-21 10:00:00", "item_price": "5.00"},
    ]
    found = trends.sales_trends(lines(spark, rows), silver.clean_date_dim(samples.dates(spark, "21-02-2023", "21-02-2023")))
    got = found.collect()
    assert {r["level"] for r in got} == {"+".join(level) or "total" for level in _as_named()}
    total = [r for r in got if r["level"] == "total"]
    assert [(r["line_count"], r["net_revenue"]) for r in total] == [(5, Decimal("26.00"))]
    years = {r["year"]: r for r in got if r["level"] == "year"}
    assert {y: r["last_year_net_revenue"] for y, r in years.items()} == {None: None, 2022: None, 2023: Decimal("8.00"), 2025: None}
    assert years[2023]["revenue_change"] == Decimal("0.5000")
    for level in ("year", "item_category", "restaurant_id", "year+month+week+item_category+restaurant_id"):
        assert sum(r["net_revenue"] for r in got if r["level"] == level) == Decimal("26.00")


def _as_named():
    return [tuple(c for c in trends.TREND_COLUMNS if c in level) for level in trends.TREND_LEVELS]


def test_churn_risk_by_gaps_and_spend(spark):
    day = lambda n: date(2023, 1, 1 + n)
    rows = [("often", day(n), "10") for n in (0, 2, 4, 29)]
    rows += [("often", day(29), "5"), ("once", day(3), "7"), ("late", day(0), "1"), ("late", day(4), "1"), ("gone", day(0), "1"), ("gone", day(1), "1")]
    rows += [("less", day(n), "100") for n in range(10, 15)] + [("less", day(n), "1") for n in range(25, 30)]
    rows += [(None, day(30), "9"), ("often", None, "9"), ("now", day(30), "2"), ("now", day(28), "2"), ("late", day(26), "0")]
    got = by(trends.churn_risk(orders(spark, *rows)), "user_id")
    assert {user: r["churn_risk"] for user, r in got.items()} == {
        "often": "active", "once": "single_visit", "late": "active", "gone": "lapsed", "less": "declining", "now": "active",
    }
    often = got["often"]
    assert (often["order_days"], often["longest_gap_days"], often["average_gap_days"]) == (4, 25, Decimal("9.67"))
    assert often["days_since_last_order"] == 1 and often["recent_net_revenue"] == Decimal("45.00")
    assert got["less"]["spend_change"] == Decimal("-0.9900")
    assert trends.churn_risk(orders(spark)).count() == 0


def test_a_hot_customer_is_one_row_a_day(spark):
    rows = [("hot", date(2023, 1, 1 + n % 20), "1") for n in range(3000)] + [(f"u{n}", date(2023, 1, 5), "2") for n in range(50)]
    got = by(trends.churn_risk(orders(spark, *rows)), "user_id")
    assert len(got) == 51 and (got["hot"]["order_days"], got["hot"]["longest_gap_days"]) == (20, 1)


@pytest.mark.parametrize("count", [0, 1, 400])
def test_ranks_are_those_of_sql(spark, count):
    df = spark.range(count).select("id", F.when(F.col("id") % 7 != 0, (F.col("id") * 37) % 50).alias("value"))
    df.createOrReplaceTempView("ranked_values")
    want = spark.sql(
        "select id, rank() over (order by value desc nulls last) as r, dense_rank() over (order by value desc nulls last) as d from ranked_values"
    )
    for partitions in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = ranking.with_ranks(df, "value", "r", "d")
            assert sorted(map(tuple, got.select("id", "r", "d").collect())) == sorted(map(tuple, want.collect()))
            placed = ranking.with_positions(df, [F.desc_nulls_last("value"), F.col("id")])
            ordered = [r["id"] for r in df.orderBy(F.desc_nulls_last("value"), "id").collect()]
            assert [r["id"] for r in sorted(placed.collect(), key=lambda r: r["position"])] == ordered
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_ranking_brings_nothing_to_one_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 90).alias("value"))
    plan = ranking.with_ranks(df, "value")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_locations_with_ties(spark):
    rows = [(f"u{n}", date(2023, 1, 1), net, place, None) for n, (place, net) in enumerate([("a", "5"), ("b", "5"), ("c", "9"), ("c", "1"), (None, "2")])]
    got = by(trends.location_ranking(orders(spark, *rows)), "restaurant_id")
    assert {k: (r["revenue_rank"], r["revenue_dense_rank"], r["order_rank"]) for k, r in got.items()} == {
        "c": (1, 1, 1), "a": (2, 2, 2), "b": (2, 2, 2), None: (4, 3, 2),
    }


def test_cohorts_come_back_and_days_merge(spark):
    rows = [
        ("m1", date(2023, 1, 5), "10", "R1", True), ("m1", date(2023, 1, 9), "10", "R1", None), ("m1", date(2023, 3, 1), "5", "R1", False),
        ("m2", date(2023, 1, 6), "10", "R1", True), ("x", date(2023, 1, 7), "1", "R1", False), ("x", date(2024, 1, 7), "2", "R1", None),
        (None, date(2023, 1, 7), "9", "R1", True), ("y", None, "9", "R1", True),
    ]
    days = trends.loyalty_days(orders(spark, *rows))
    got = {(r["is_member"], r["months_since"]): r for r in trends.loyalty_cohorts(days).collect()}
    assert {k: (r["cohort_size"], r["customers"], r["repeat_rate"], r["order_count"]) for k, r in got.items()} == {
        (True, 0): (2, 2, Decimal("1.0000"), 3), (True, 2): (2, 1, Decimal("0.5000"), 1),
        (False, 0): (1, 1, Decimal("1.0000"), 1), (False, 12): (1, 1, Decimal("1.0000"), 1),
    }
    assert got[True, 0]["net_revenue_per_customer"] == Decimal("15.00")
    assert trends.loyalty_cohorts(trends.loyalty_days(orders(spark))).count() == 0


def test_bitmaps_are_built_where_customers_met(spark):
    """Rows of single customers move, not a bitmap of 4 kB for each task's share of them."""
    rows = [(f"u{n % 300}", date(2023, 1, 1 + n % 4), "1.50", "R1", n % 3 == 0) for n in range(1_200)]
    days = trends.loyalty_days(orders(spark, *rows).repartition(8))
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("bitmap_construct_agg") < plan.index("Exchange"), plan
    got = days.select("*", F.bitmap_count("customers").alias("n")).collect()
    assert len({(r["is_member"], r["cohort_month"], r["order_date"], r["bucket"]) for r in got}) == len(got)
    assert len({(r["is_member"], r["order_date"]) for r in got}) == 8
    assert sum(r["n"] for r in got) == 300
    assert sum(r["order_count"] for r in got) == 1_200 and sum(r["net_revenue"] for r in got) == Decimal("1800.00")


def test_discounts_are_compared_within_item_and_location(spark):
    items = [{"lineitem_id": f"d{n}", "item_name": "cheap", "item_price": "10.00"} for n in range(2)]
    items += [{"lineitem_id": f"f{n}", "item_name": "cheap", "item_price": "10.00"} for n in range(4)]
    items += [{"lineitem_id": "only", "item_name": "dear", "item_price": "90.00"}, {"lineitem_id": "alone", "item_name": "gift", "item_price": "30.00"}]
    options = [{"lineitem_id": key, "option_price": "-1.00"} for key in ("d0", "d1", "alone")]
    got = {r["is_total"]: r for r in trends.discount_effectiveness(lines(spark, items, options)).collect()}
    for row in got.values():
        assert (row["matched_strata"], row["unmatched_strata"]) == (1, 2)
        assert (row["matched_discounted_lines"], row["unmatched_discounted_lines"]) == (2, 1)
        assert (row["avg_net_discounted"], row["avg_net_full_price"], row["net_effect"]) == (Decimal("9.00"), Decimal("10.00"), Decimal("-1.00"))
    none = trends.discount_effectiveness(lines(spark, items[:1])).first()
    assert none["avg_net_discounted"] is None and none["matched_discounted_lines"] == 0
