"""Customer marts: daily lifetime value, snapshot, and RFM segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.casts import MONEY
from tallyhouse.functions.measures import distinct, money_sum, rows, total
from tallyhouse.operators.ranking import with_ntiles
from tallyhouse.sources.scratch import stage

# Tier names from the lowest quartile up, and segment names.
CLV_TIERS = ("low", "medium_low", "medium_high", "high")
RFM_SEGMENTS = (
    "champions",
    "loyal_high_value",
    "new_or_promising",
    "at_risk_high_value",
    "needs_attention",
    "hibernating",
)


def customer_orders(orders: DataFrame) -> DataFrame:
    """Orders that can be attributed to a customer."""
    return orders.where(F.col("user_id").isNotNull()).select(
        "user_id",
        "order_id",
        "order_date",
        "restaurant_id",
        "is_loyalty",
        "gross_item_revenue",
        "option_revenue",
        "discount_amount",
        "net_order_revenue",
    )


def customer_orders_summary(attributed: DataFrame) -> DataFrame:
    return attributed.agg(
        rows("order_count"), money_sum("net_order_revenue", "total_net_order_revenue")
    )


def daily_customer_spend(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy("user_id", "order_date").agg(
        F.count("order_id").alias("daily_order_count"),  # unique in the order fact
        distinct("restaurant_id", "daily_restaurant_count"),
        money_sum("gross_item_revenue", "daily_gross_item_revenue"),
        money_sum("option_revenue", "daily_option_revenue"),
        money_sum("discount_amount", "daily_discount_amount"),
        money_sum("net_order_revenue", "daily_net_revenue"),
        F.bool_or("is_loyalty").alias("is_loyalty_customer_day"),
    )


def customer_cumulative(daily: DataFrame) -> DataFrame:
    """Running totals per customer.

    A customer has at most one row per calendar day here, so no window partition
    outgrows the calendar, however many orders one customer places.
    """
    everything = Window.partitionBy("user_id")
    so_far = everything.orderBy("order_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return daily.select(
        "*",
        F.sum("daily_order_count").over(so_far).alias("cumulative_order_count"),
        F.sum("daily_net_revenue").over(so_far).cast(MONEY).alias("cumulative_net_revenue"),
        F.min("order_date").over(everything).alias("first_order_date"),
        F.max("order_date").over(everything).alias("latest_order_date"),
    ).withColumn(
        "customer_lifetime_days", F.date_diff("latest_order_date", "first_order_date") + 1
    )


def _tier(quartile: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in CLV_TIERS]), quartile)


def _with_clv_tier(staged: DataFrame, by: list[str]) -> DataFrame:
    ranked = with_ntiles(staged, {"clv_quartile": by})
    return ranked.withColumn("clv_tier", _tier(F.col("clv_quartile")))


def customer_daily_clv(orders: DataFrame) -> DataFrame:
    """Customer days with running value and its quartile among all customer days."""
    cumulative = customer_cumulative(daily_customer_spend(customer_orders(orders)))
    staged = stage(cumulative, "customer_cumulative")
    return _with_clv_tier(staged, ["cumulative_net_revenue", "order_date", "user_id"])


def customer_daily_clv_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        distinct("user_id", "distinct_customer_count"),
        money_sum("daily_net_revenue", "total_daily_net_revenue"),
        F.max("cumulative_net_revenue").alias("max_cumulative_net_revenue"),
    )


def customer_latest_row(daily_clv: DataFrame) -> DataFrame:
    """Each customer's newest day, under lifetime and latest-day names."""
    newest_first = Window.partitionBy("user_id").orderBy(
        F.col("order_date").desc(), F.col("cumulative_net_revenue").desc()
    )
    newest = daily_clv.withColumn("_recency", F.row_number().over(newest_first)).where(
        "_recency = 1"
    )
    return newest.select(
        "user_id",
        "first_order_date",
        "latest_order_date",
        "customer_lifetime_days",
        F.col("cumulative_order_count").alias("lifetime_order_count"),
        F.col("cumulative_net_revenue").alias("lifetime_net_revenue"),
        F.col("daily_order_count").alias("latest_daily_order_count"),
        F.col("daily_net_revenue").alias("latest_daily_net_revenue"),
        F.col("daily_restaurant_count").alias("latest_daily_restaurant_count"),
        F.col("is_loyalty_customer_day").alias("latest_is_loyalty_customer_day"),
    )


def customer_clv_snapshot(daily_clv: DataFrame) -> DataFrame:
    """One row per customer, ranked among customers (not among customer days)."""
    staged = stage(customer_latest_row(daily_clv), "customer_latest_row")
    return _with_clv_tier(staged, ["lifetime_net_revenue", "user_id"])


def clv_snapshot_summary(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        rows("row_count"),
        distinct("user_id", "distinct_customer_count"),
        money_sum("lifetime_net_revenue", "total_lifetime_net_revenue"),
        F.max("lifetime_net_revenue").alias("max_lifetime_net_revenue"),
    )


def _count_by_label(mart: DataFrame, column: str, labels: tuple[str, ...]) -> DataFrame:
    """Rows per label in one pass, zero for labels that do not occur."""
    counts = mart.agg(*[F.count_if(F.col(column) == label).alias(label) for label in labels])
    listed = F.array(
        *[F.struct(F.lit(label).alias(column), F.col(label).alias("customer_count")) for label in labels]
    )
    return counts.select(F.inline(listed))


def clv_tier_counts(snapshot: DataFrame) -> DataFrame:
    return _count_by_label(snapshot, "clv_tier", CLV_TIERS)


def rfm_as_of_date(snapshot: DataFrame) -> DataFrame:
    """The newest order date in the data stands for today."""
    return snapshot.agg(F.max("latest_order_date").alias("rfm_as_of_date"))


def rfm_base(snapshot: DataFrame) -> DataFrame:
    """Snapshot columns for scoring, recency added; accepts older tier column names."""
    renamed = snapshot.withColumnsRenamed(
        {
            name: name.removeprefix("latest_")
            for name in ("latest_clv_quartile", "latest_clv_tier")
            if name in snapshot.columns
        }
    )
    return renamed.select(
        "user_id",
        "first_order_date",
        "latest_order_date",
        "customer_lifetime_days",
        "lifetime_order_count",
        "lifetime_net_revenue",
        "clv_quartile",
        "clv_tier",
        F.date_diff(rfm_as_of_date(snapshot).scalar(), "latest_order_date").alias("recency_days"),
    )


def rfm_scores(snapshot: DataFrame) -> DataFrame:
    """Quartile scores, 4 the best. All three rankings share their passes.

    ``rfm_score`` is the numeric total as a double, as consumers know it;
    ``rfm_code`` is the three digits side by side.
    """
    ranked = with_ntiles(
        stage(rfm_base(snapshot), "rfm_base"),
        {
            "recency_quartile": ["recency_days", "user_id"],
            "frequency_score": ["lifetime_order_count", "user_id"],
            "monetary_score": ["lifetime_net_revenue", "user_id"],
        },
    )
    scored = ranked.withColumn("recency_score", 5 - F.col("recency_quartile"))
    digits = ("recency_score", "frequency_score", "monetary_score")
    total_score = sum((F.col(name) for name in digits[1:]), F.col(digits[0]))
    return scored.drop("recency_quartile").select(
        "*",
        total_score.cast("double").alias("rfm_score"),
        total_score.alias("rfm_total_score"),
        F.concat(*[F.col(name).cast("string") for name in digits]).alias("rfm_code"),
    )


# Segment, then lowest and highest recency, frequency and monetary score. The first that fits wins.
SEGMENTS = (
    ("champions", (4, 4), (4, 4), (4, 4)),
    ("loyal_high_value", (3, 4), (3, 4), (3, 4)),
    ("new_or_promising", (4, 4), (1, 2), (1, 4)),
    ("at_risk_high_value", (1, 2), (3, 4), (3, 4)),
    ("hibernating", (1, 2), (1, 2), (1, 4)),
)
OTHER_SEGMENT = "needs_attention"


def _segment() -> Column:
    scores = [F.col(name) for name in ("recency_score", "frequency_score", "monetary_score")]
    segment = F.lit(OTHER_SEGMENT)
    for name, *ranges in reversed(SEGMENTS):
        fits = [score.between(*ends) for score, ends in zip(scores, ranges, strict=True)]
        segment = F.when(fits[0] & fits[1] & fits[2], name).otherwise(segment)
    return segment


def customer_rfm(snapshot: DataFrame) -> DataFrame:
    return rfm_scores(snapshot).select(
        "*",
        _segment().alias("rfm_segment"),
        rfm_as_of_date(snapshot).scalar().alias("rfm_as_of_date"),
    )


def rfm_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        distinct("user_id", "distinct_customer_count"),
        money_sum("lifetime_net_revenue", "total_lifetime_net_revenue"),
    )


def rfm_segment_counts(mart: DataFrame) -> DataFrame:
    return _count_by_label(mart, "rfm_segment", RFM_SEGMENTS)
