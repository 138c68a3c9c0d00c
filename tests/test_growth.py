"""What whole runs move, keep on disk and read again as tables grow."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import gold, silver
from tallyhouse.operators.profile import ITEMS, OPTIONS
from tallyhouse.plans import queries
from tallyhouse.plans.layers import run_layers
from tallyhouse.plans.profiling import profile_run
from tallyhouse.session import FREE_EXCHANGES
from tallyhouse.sources.scratch import stage
from tests.support import samples
from tests.test_layers import sources
from tests.test_partitioning import plan_of, tables


def awkward_lines(spark):
    rng = random.Random(2)
    rows = [
        {
            "order_id": rng.choice([None, "hot", "hot", f"o{rng.randint(0, 40)}", f"o{rng.randint(0, 40)}"]),
            "lineitem_id": rng.choice([None, *[f"l{n}" for n in range(9)]]),
            "creation_time_utc": rng.choice([None, "2023-02-21T22:40:01.000Z", "2023-02-20T02:00:00.000Z"]),
            "restaurant_id": rng.choice([None, "R1", "R2"]),
            "user_id": rng.choice([None, "u1", "u2"]),
            "is_loyalty": rng.choice([None, "true", "false"]),
            "item_price": rng.choice([None, "1.10", "2.00"]),
        }
        for _ in range(500)
    ]
    options = [{"order_id": rng.choice([None, "hot", f"o{n}"]), "lineitem_id": f"l{n % 9}", "option_price": "-0.50"} for n in range(40)]
    items = silver.clean_order_items(samples.items(spark, *rows))
    rolled = gold.options_by_lineitem(silver.clean_order_item_options(samples.options(spark, *options)))
    return stage(gold.fact_order_line(items, rolled).repartition(5), "lines")


def test_orders_of_written_lines_are_the_same(spark):
    lines = awkward_lines(spark)
    for some in (lines, lines.where("lineitem_id is null"), lines.where("order_id is null"), lines.limit(0)):
        ours, plain = gold.fact_order_of_written(some), gold.fact_order(some)
        assert ours.schema.simpleString() == plain.schema.simpleString()
        assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_written_lines_are_moved_as_orders(spark):
    """Lines are exchanged by their keys alone; all else is combined to one row for each order and task before."""
    plan = plan_of(gold.fact_order_of_written(awkward_lines(spark)))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, lineitem_id#\d+", plan)) == 1, plan
    assert "Expand" not in plan and "partial_count(distinct" not in plan and "Join" not in plan, plan


@pytest.mark.parametrize("query", ["gate_report", "show_tables", "reconcile_marts"])
def test_lines_are_built_once_for_both_facts(spark, tmp_path, monkeypatch, query):
    folder = tables(spark, tmp_path, F.col("id") / 4, lines=400)
    made = []
    build = queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, name: made.append((name, df.inputFiles())) or build(df, name))
    assert queries.QUERIES[query](spark, folder).count() > 0
    assert [name for name, read in made if any("lineitem" in path for path in read)] == ["options_clean", "fact_order_line"]


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(name) for name in re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().mkString(" "))}


def test_what_a_run_exchanged_is_gone_when_it_ends(spark, tmp_path):
    before = shuffle_files(spark)
    run_layers(spark, sources(spark), str(tmp_path), "2023-05-01")
    assert not shuffle_files(spark) - before
    # outside such a run nothing goes early: rows that are read bit by bit are exchanged while they are read
    assert spark.conf.get(FREE_EXCHANGES) == "false"
    assert [r["id"] for r in spark.range(0, 50, 1, 5).orderBy(F.desc("id")).toLocalIterator()] == list(range(49, -1, -1))


def test_layers_are_packed_densely(spark, tmp_path):
    run_layers(spark, sources(spark), str(tmp_path), "2023-05-01")
    files = [path.name for path in tmp_path.rglob("part-*.parquet")]
    assert files and all(".zstd." in name for name in files)


def test_a_profiling_run_reads_each_source_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    items = samples.items(spark, *[{"order_id": f"o{n}"} for n in range(7)])
    options = samples.options(spark, *[{"order_id": f"o{n}"} for n in range(5)]).withColumnRenamed("option_name", "Option, (name)")
    frames = {name: df.mapInArrow(seen, df.schema) for name, df in {ITEMS: items, OPTIONS: options}.items()}
    frames["none.csv"] = spark.range(3).select()
    paths = profile_run(spark, frames, str(tmp_path))
    assert read.value == 12
    summary = {r["file"]: r for r in spark.read.csv(paths["data_profile_summary"], header=True).collect()}
    assert summary[ITEMS]["rows"] == "7" and "Option, (name)=1" in summary[OPTIONS]["top_cardinality_cols"]
