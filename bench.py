"""Time the headline queries; prints one JSON line.

Each query runs from the source tables to a result nobody keeps, so the whole
result is computed. Before that each runs once over the smallest sibling folder, so
that JVM start-up and code generation are not measured. The source tables come as one file with one
row group each, which one task would read and explode; they are first written again as
one file a core, as any large table lies, and that is not measured either.
Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES.
"""

from __future__ import annotations

import json
import os
import re
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tallyhouse.plans.queries import QUERIES
from tallyhouse.session import build_session
from tallyhouse.sources import files
from tallyhouse.sources.scratch import scratch_path
from tallyhouse.sources.star_schema import SCHEMAS

HEADLINE = (
    "clean_order_items",
    "clean_order_item_options",
    "options_by_lineitem",
    "fact_order_line",
    "fact_order",
    "customer_daily_clv",
    "customer_clv_snapshot",
    "customer_rfm",
    "daily_sales",
    "restaurant_daily_sales",
    "item_sales",
    "restaurant_item_sales",
    "option_sales",
    "top_items",
    "top_restaurants",
    "customers_by_rfm_segment",
    "option_revenue_gap",
    "profile_summary",
    "validate_key",
    "data_quality_report",
    "run_layers",
)


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def in_several_files(spark: SparkSession, folder: str, cpus: int) -> str:
    """The tables the queries read, in as many files as there are cores."""
    copy = scratch_path(spark, "bench")
    for name in SCHEMAS:
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(cpus).write.parquet(f"{copy}/{name}.parquet")
    return copy


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = build_session(
        "tallyhouse-bench",
        spark__master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(folder).parent / "sf0.001"
    for name in names:
        run(spark, name, str(small) if small.exists() else folder)
    copy = in_several_files(spark, folder, int(cpus))
    seconds = {name: run(spark, name, copy) for name in names}
    files.delete(spark, copy)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
