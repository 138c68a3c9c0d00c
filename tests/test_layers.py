import pytest

from pyspark.sql import functions as F

from tallyhouse.operators import gold, silver
from tallyhouse.operators.checks import GateError, enforce, written_gate
from tallyhouse.plans import layers
from tallyhouse.plans.layers import LAYER_OF, MARTS, base_path, run_layers, table_paths, today
from tallyhouse.session import sized_shuffles
from tallyhouse.sources import files, publishing, scratch
from tallyhouse.sources.layers import read_layer
from tests.support import samples


def sources(spark):
    items = [{"order_id": f"o{n}", "lineitem_id": f"l{n}", "user_id": f"u{n % 5}"} for n in range(20)]
    return {
        "order_items": samples.items(spark, *items),
        "order_item_options": samples.options(spark, {"order_id": "o3", "lineitem_id": "l3"}),
        "date_dim": samples.dates(spark, "21-02-2023"),
    }


def test_everything_is_published_for_one_date(spark, tmp_path):
    root = str(tmp_path)
    run = run_layers(spark, sources(spark), root, "2023-05-01")
    assert set(run.layers) == set(LAYER_OF)
    assert all(row["ok"] for row in run.gates if row["severity"] == "error")
    counts = {name: df.count() for name, df in run.layers.items()}
    assert counts["fact_order_line"] == counts["fact_order"] == counts["order_items"] == 20
    assert counts["customer_rfm"] == 5 and counts["daily_sales"] == 1
    again = run_layers(spark, sources(spark), root, "2023-05-01")
    assert {name: df.count() for name, df in again.layers.items()} == counts
    assert set(table_paths(root)) == set(MARTS)


def test_a_failed_gate_publishes_nothing_of_that_dataset(spark, tmp_path):
    broken = sources(spark)
    broken["date_dim"] = samples.dates(spark, "21-02-2023", "2023-02-21")
    with pytest.raises(GateError, match="date_dim keys are unique"):
        run_layers(spark, broken, str(tmp_path), "2023-05-01")
    assert not (tmp_path / "mart" / "daily_sales" / "ingest_date=2023-05-01").exists()
    assert not list(tmp_path.glob("*/*/_drafts/*"))
    assert read_layer(spark, base_path(str(tmp_path), "fact_order"), "2023-05-01").count() == 20


def scratch_tables(spark):
    folder = f"{scratch.scratch_root(spark)}/tallyhouse/{spark.sparkContext.applicationId}"
    return {name for name, *_ in files.listing(spark, folder)} if files.exists(spark, folder) else set()


def test_every_dataset_is_written_once_and_scratch_is_empty_afterwards(spark, tmp_path, monkeypatch):
    drafts = []
    monkeypatch.setattr(layers, "write_draft", lambda df, base, *rest: drafts.append(base) or publishing.write_draft(df, base, *rest))
    before = scratch_tables(spark)
    run = run_layers(spark, sources(spark), str(tmp_path), "2023-05-01")
    assert sorted(drafts) == sorted(base_path(str(tmp_path), name) for name in LAYER_OF)
    assert scratch_tables(spark) == before
    assert not list(tmp_path.glob("*/*/_drafts"))
    totals = gold.fact_order_line_totals(run["fact_order_line"]).first().asDict()
    assert {name: run.observed["fact_order_line"][name] for name in totals} == totals
    quality = silver.order_items_quality(run["order_items_clean"]).first().asDict()
    assert run.observed["order_items_clean"] == quality
    assert all(run.observed[name]["row_count"] == df.count() for name, df in run.layers.items())


def test_a_row_lost_while_cleaning_stops_the_run(spark, tmp_path, monkeypatch):
    before = scratch_tables(spark)
    clean, measures = layers._CLEANERS["order_items"]
    monkeypatch.setitem(layers._CLEANERS, "order_items", (lambda raw: clean(raw).where("order_id != 'o7'"), measures))
    with pytest.raises(GateError, match="order_items_clean: row count preserved: expected 20"):
        run_layers(spark, sources(spark), str(tmp_path), "2023-05-01")
    assert not list((tmp_path / "silver" / "order_items_clean").glob("*"))
    assert scratch_tables(spark) == before


def test_rows_lost_between_the_write_and_the_files_are_seen(spark, tmp_path):
    draft = publishing.write_draft(spark.range(10), str(tmp_path), "2023-01-01", F.sum("id").alias("total"))
    assert draft.observed == {"row_count": 10, "total": 45}
    assert enforce(written_gate("numbers", draft.observed["row_count"], draft.df))[0]["ok"]
    with pytest.raises(GateError, match="all rows were written"):
        enforce(written_gate("numbers", 11, draft.df))
    empty = publishing.write_draft(spark.range(10).where("id < 0"), str(tmp_path), "2023-01-02")
    assert enforce(written_gate("numbers", empty.observed.get("row_count"), empty.df))[0]["ok"]


def test_publishing_replaces_a_date_or_leaves_it(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "set")
    for count in (3, 5):
        publishing.publish(publishing.write_draft(spark.range(count), base, "2023-01-01"))
        assert read_layer(spark, base, "2023-01-01").count() == count
    late = publishing.write_draft(spark.range(9), base, "2023-01-01")
    assert spark.read.parquet(base).count() == 5  # a draft is invisible
    rename, calls = files.rename, []

    def failing(session, old, new):
        calls.append(new)
        if old == late.path:
            raise OSError("no")
        rename(session, old, new)

    monkeypatch.setattr(files, "rename", failing)
    with pytest.raises(OSError, match="no"):
        publishing.publish(late)
    assert read_layer(spark, base, "2023-01-01").count() == 5
    publishing.withdraw(late)
    assert [p.name for p in (tmp_path / "set").glob("*")] == ["ingest_date=2023-01-01"]


def test_the_run_date_is_the_utc_day():
    assert len(today()) == 10


def test_shuffles_grow_with_the_data_within_a_run_only(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 10) as count:
        assert count == int(before)
    with sized_shuffles(spark, 10**15) as count:
        assert count == 500_000_000 and spark.conf.get("spark.sql.shuffle.partitions") == str(count)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
