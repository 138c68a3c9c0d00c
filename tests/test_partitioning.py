from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.queries import Frames

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SPLIT = LARGE | {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "64",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def tables(spark, folder, order_key, lines=4_000):
    """Star-schema tables whose lines have the given order key."""
    number = F.col("id")
    line = spark.range(lines, numPartitions=8).select(
        order_key.cast("bigint").alias("l_orderkey"),
        (number % 50).alias("l_partkey"),
        number.alias("l_suppkey"),
        (number % 7).cast("int").alias("l_linenumber"),
        (1 + number % 5).cast("double").alias("l_quantity"),
        F.when(number % 3 == 0, 0.07).otherwise(0.0).alias("l_discount"),
        F.lit(0.02).alias("l_tax"),
        F.lit("N").alias("l_returnflag"),
    )
    orders = spark.range(lines).select(
        number.alias("o_orderkey"), (number % 90).alias("o_custkey"), F.lit("2024-03-05").cast("timestamp_ntz").alias("o_orderdate")
    )
    customers = spark.range(90).select(number.alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"))
    parts = spark.range(50).select(
        number.alias("p_partkey"), F.md5(number.cast("string")).alias("p_name"), F.lit("T").alias("p_type"), F.lit(3.5).alias("p_retailprice")
    )
    for name, df in {"lineitem": line, "orders": orders, "customer": customers, "part": parts}.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_are_built_where_their_lines_met_the_order(spark, tmp_path):
    """One exchange by order for the lines; neither the option join nor the grouping moves them again."""
    folder = tables(spark, tmp_path, F.col("id") / 4)
    with settings(spark, LARGE):
        orders = Frames(spark, folder).orders
        plan = plan_of(orders).split("Initial Plan")[0]
        # parts and lines by part, lines and orders by order, customers and orders by customer, options twice
        assert plan.count("Exchange hashpartitioning") == 8, plan
        assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning"), plan
        assert orders.count() == 1_000
        assert orders.agg(F.sum("line_item_count")).first()[0] == 4_000


@pytest.mark.parametrize("hot", [8, None])
def test_a_hot_order_is_split_and_counted_whole(spark, tmp_path, hot):
    """A third of all lines share one order id, or have none."""
    folder = tables(spark, tmp_path, F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(10 + F.col("id")), lines=30_000)
    frames = Frames(spark, folder)  # sets the session up; the settings below must hold afterwards
    with settings(spark, SPLIT):
        rows = frames.orders.orderBy(F.desc("line_item_count")).collect()
        assert len(rows) == 20_001
        assert (rows[0]["line_item_count"], rows[0]["distinct_line_item_count"]) == (10_000, 10_000)
        frames.orders.collect()
        assert "skew=true" in plan_of(frames.orders)
