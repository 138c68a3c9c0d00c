"""Metrics that the sources allow beyond the marts: seasons, churn, locations, loyalty, discounts."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.casts import MONEY, RATE
from tallyhouse.functions.measures import distinct, money_sum, per, rows, share, total
from tallyhouse.operators.customers import customer_orders, daily_customer_spend
from tallyhouse.operators.ranking import with_positions, with_ranks
from tallyhouse.sources.scratch import stage

# --- sales trends and seasonality ------------------------------------------------

TREND_COLUMNS = ("year", "month", "week", "is_holiday", "item_category", "restaurant_id")
_PERIODS = ((), ("year",), ("year", "month"), ("year", "month", "week"))
_DIMENSIONS = ((), ("item_category",), ("restaurant_id",), ("item_category", "restaurant_id"))
# Every period with every choice of dimensions, and holidays against other days.
TREND_LEVELS = (*[p + d for p, d in product(_PERIODS, _DIMENSIONS)], ("is_holiday",), ("year", "is_holiday"))


def sales_trends(lines: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Lines, quantity and net revenue at every trend level, with the same period of the year before.

    ``level`` names the columns that are set; ``grouping_id`` has a one bit for each that is summed over. Weeks
    are ISO weeks. Lines are summed by day, category and location before they meet the calendar and
    before rows are copied for the levels. The year before is found by its number, so a missing year is a null.
    """
    by_day = lines.groupBy("order_date", "item_category", "restaurant_id").agg(
        rows("line_count"), total("item_quantity"), F.sum("net_line_revenue").alias("net_revenue")
    )
    holidays = date_dim.where("date_key is not null").groupBy("date_key").agg(F.bool_or("is_holiday").alias("is_holiday"))
    dated = by_day.join(holidays, F.col("order_date") == F.col("date_key"), "left").select(
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
        F.weekofyear("order_date").alias("week"),
        F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
        "item_category",
        "restaurant_id",
        "line_count",
        "item_quantity",
        "net_revenue",
    )
    level = F.concat_ws("+", *[F.when(F.grouping(name) == 0, F.lit(name)) for name in TREND_COLUMNS])
    grouped = dated.groupingSets([list(names) for names in TREND_LEVELS], *TREND_COLUMNS).agg(
        F.grouping_id(*TREND_COLUMNS).alias("grouping_id"),
        F.when(level == "", "total").otherwise(level).alias("level"),
        total("line_count"),
        total("item_quantity"),
        money_sum("net_revenue"),
    )
    same = [name for name in TREND_COLUMNS if name != "year"]
    year_before = Window.partitionBy("grouping_id", *same).orderBy("year").rangeBetween(-1, -1)
    compared = grouped.withColumn(
        "last_year_net_revenue", F.when(F.col("year").isNotNull(), F.sum("net_revenue").over(year_before)).cast(MONEY)
    )
    return compared.withColumn("revenue_change", _change("net_revenue", "last_year_net_revenue"))


def _change(now: str, before: str) -> Column:
    """Change as a share of what was before; null unless that is positive."""
    gain = F.when(F.col(before) > 0, F.col(now) - F.col(before))
    return F.try_divide(gain, F.col(before)).cast(RATE)


# --- churn risk ------------------------------------------------------------------

COMPARED_DAYS = 5


def churn_risk(orders: DataFrame, compared_days: int = COMPARED_DAYS) -> DataFrame:
    """Per customer: days since the last order, gaps between order days, and recent against earlier spend.

    Orders are summed by day first, so a customer has at most one row a calendar day however many orders there
    are. The spend of the last ``compared_days`` order days is compared with that of as many before. The risk
    compares the days since the last order with the customer's own longest gap.
    """
    attributed = customer_orders(orders).where("order_date is not null")
    as_of = attributed.agg(F.max("order_date")).scalar()
    newest = Window.partitionBy("user_id").orderBy(F.desc("order_date"))
    days = daily_customer_spend(attributed).select(
        "user_id",
        "order_date",
        "daily_net_revenue",
        F.row_number().over(newest).alias("age"),
        F.datediff("order_date", F.lead("order_date").over(newest)).alias("gap"),
    )
    recent, earlier = F.col("age") <= compared_days, F.col("age").between(compared_days + 1, 2 * compared_days)
    summed = days.groupBy("user_id").agg(
        F.max("order_date").alias("last_order_date"),
        rows("order_days"),
        F.sum("gap").alias("gap_days"),
        F.count("gap").alias("gaps"),
        F.max("gap").alias("longest_gap_days"),
        F.sum(F.when(recent, F.col("daily_net_revenue"))).cast(MONEY).alias("recent_net_revenue"),
        F.sum(F.when(earlier, F.col("daily_net_revenue"))).cast(MONEY).alias("earlier_net_revenue"),
    )
    since, longest = F.col("days_since_last_order"), F.col("longest_gap_days")
    risk = (
        F.when(longest.isNull(), "single_visit")
        .when(since > 2 * longest, "lapsed")
        .when(since > longest, "at_risk")
        .when(F.col("recent_net_revenue") * 2 < F.col("earlier_net_revenue"), "declining")
        .otherwise("active")
    )
    return summed.select(
        "user_id",
        "last_order_date",
        F.datediff(as_of, F.col("last_order_date")).alias("days_since_last_order"),
        "order_days",
        per("gap_days", "gaps", "average_gap_days"),
        "longest_gap_days",
        "recent_net_revenue",
        "earlier_net_revenue",
        _change("recent_net_revenue", "earlier_net_revenue").alias("spend_change"),
    ).withColumn("churn_risk", risk)


# --- location ranking --------------------------------------------------------------


def location_ranking(orders: DataFrame) -> DataFrame:
    """Locations by net revenue and by orders, with gaps after ties and without."""
    by_location = orders.groupBy("restaurant_id").agg(
        F.count("order_id").alias("order_count"),  # unique in the order fact
        distinct("user_id", "customer_count"),
        money_sum("net_order_revenue", "net_revenue"),
    )
    measured = stage(by_location.select("*", per("net_revenue", "order_count", "avg_order_value")), "locations")
    by_revenue = with_ranks(measured, "net_revenue", "revenue_rank", "revenue_dense_rank")
    return with_ranks(by_revenue, "order_count", "order_rank", "order_dense_rank")


# --- loyalty impact ------------------------------------------------------------------


def numbered_customers(attributed: DataFrame) -> DataFrame:
    """Every customer with a number from 0, whether a member, and the month of the first order."""
    customers = attributed.groupBy("user_id").agg(
        F.coalesce(F.bool_or("is_loyalty"), F.lit(False)).alias("is_member"),
        F.trunc(F.min("order_date"), "month").alias("cohort_month"),
    )
    placed = with_positions(customers, [F.col("user_id")])
    return placed.select("user_id", "is_member", "cohort_month", (F.col("position") - 1).alias("number"))


def loyalty_days(orders: DataFrame) -> DataFrame:
    """Per membership, cohort and day the customers as bitmaps, and their orders and revenue.

    Bitmaps hold exact sets, so days can be kept and merged to any longer period without going back to orders. Customers
    are brought together before a bitmap is built: a bitmap of each task's share would have 4 kB for a few of them.
    """
    attributed = customer_orders(orders).where("order_date is not null")
    customers = stage(numbered_customers(attributed), "customers")
    days = daily_customer_spend(attributed).join(customers, "user_id")
    keys = ("is_member", "cohort_month", "order_date", "bucket")
    together = days.withColumn("bucket", F.bitmap_bucket_number("number")).repartition(*keys)
    return together.groupBy(*keys).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers"),
        F.sum("daily_order_count").alias("order_count"),
        F.sum("daily_net_revenue").alias("net_revenue"),
    )


def loyalty_cohorts(days: DataFrame) -> DataFrame:
    """Members against others by month of the first order and months since: how many come back, and what they spend.

    ``days`` is the output of :func:`loyalty_days`.
    """
    months = (
        (F.year("order_date") - F.year("cohort_month")) * 12 + F.month("order_date") - F.month("cohort_month")
    ).alias("months_since")
    merged = days.groupBy("is_member", "cohort_month", months, "bucket").agg(
        F.bitmap_or_agg("customers").alias("customers"),
        F.sum("order_count").alias("order_count"),
        F.sum("net_revenue").alias("net_revenue"),
    )
    counted = merged.groupBy("is_member", "cohort_month", "months_since").agg(
        F.sum(F.bitmap_count("customers")).alias("customers"), total("order_count"), money_sum("net_revenue")
    )
    cohort = Window.partitionBy("is_member", "cohort_month")
    sized = counted.withColumn("cohort_size", F.max(F.when(F.col("months_since") == 0, F.col("customers"))).over(cohort))
    return sized.select(
        "is_member",
        "cohort_month",
        "months_since",
        "cohort_size",
        "customers",
        share("customers", "cohort_size", "repeat_rate"),
        "order_count",
        "net_revenue",
        per("net_revenue", "customers", "net_revenue_per_customer"),
    )


# --- discount effectiveness ------------------------------------------------------------

STRATUM = ("restaurant_id", "item_category", "item_name")


def discount_effectiveness(lines: DataFrame) -> DataFrame:
    """Discounted lines against full-price lines of the same item at the same location, by category and in total.

    Full-price averages are weighted to the mix of the discounted lines, so that a different choice of items
    or places is no effect. Strata with lines of one kind only cannot be compared; they are counted.
    """
    kinds = {"discounted": F.col("has_discount"), "full": ~F.col("has_discount")}
    strata = lines.groupBy(*STRATUM).agg(
        *[F.count_if(kind).alias(f"{name}_lines") for name, kind in kinds.items()],
        *[F.coalesce(F.sum(F.when(kind, F.col("net_line_revenue"))), F.lit(0)).alias(f"{name}_net") for name, kind in kinds.items()],
        *[F.coalesce(F.sum(F.when(kind, F.col("item_quantity"))), F.lit(0)).alias(f"{name}_quantity") for name, kind in kinds.items()],
    )
    matched = (F.col("discounted_lines") > 0) & (F.col("full_lines") > 0)

    def same_mix(measure: str) -> Column:
        """What the discounted lines would have brought at the full-price average of their stratum."""
        exact = F.try_divide((F.col("discounted_lines") * F.col(measure)).cast("decimal(30,2)"), F.col("full_lines").cast("decimal(20,0)"))
        return exact.cast("decimal(26,4)")

    def over_matched(value: Column) -> Column:
        return F.sum(F.when(matched, value))

    summed = strata.rollup("item_category").agg(
        (F.grouping("item_category") == 1).alias("is_total"),
        F.count_if(matched).alias("matched_strata"),
        F.count_if(~matched).alias("unmatched_strata"),
        F.sum(F.when(~matched, F.col("discounted_lines")).otherwise(0)).alias("unmatched_discounted_lines"),
        over_matched(F.col("discounted_lines")).alias("n"),
        over_matched(F.col("discounted_net")).alias("net"),
        over_matched(same_mix("full_net")).alias("full_net"),
        over_matched(F.col("discounted_quantity")).alias("quantity"),
        over_matched(same_mix("full_quantity")).alias("full_quantity"),
    )
    averages = summed.select(
        "item_category",
        "is_total",
        "matched_strata",
        "unmatched_strata",
        F.coalesce("n", F.lit(0)).alias("matched_discounted_lines"),
        "unmatched_discounted_lines",
        per("net", "n", "avg_net_discounted"),
        per("full_net", "n", "avg_net_full_price"),
        per("quantity", "n", "avg_quantity_discounted"),
        per("full_quantity", "n", "avg_quantity_full_price"),
    )
    return averages.withColumns(
        {
            "net_effect": (F.col("avg_net_discounted") - F.col("avg_net_full_price")).cast(MONEY),
            "quantity_effect": (F.col("avg_quantity_discounted") - F.col("avg_quantity_full_price")).cast(MONEY),
        }
    )
