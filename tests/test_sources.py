import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import reports
from tallyhouse.sources import catalog, csv_files, csv_records, files, scratch
from tallyhouse.sources.jdbc import jdbc_options
from tallyhouse.sources.layers import land_raw, partition_filter, read_layer, write_layer
from tests.support.samples import by


def test_writing_a_date_replaces_only_that_date(spark, tmp_path):
    base = str(tmp_path / "layer")
    write_layer(spark.range(10), base, "2023-01-01")
    write_layer(spark.range(5), base, "2023-01-02")
    write_layer(spark.range(3).withColumn("ingest_date", F.lit("ignored")), base, "2023-01-01")
    assert read_layer(spark, base, "2023-01-01").count() == 3
    assert read_layer(spark, base, "2023-01-02").count() == 5
    assert read_layer(spark, base, "2023-01-01").columns == ["id"]
    part = next((tmp_path / "layer" / "ingest_date=2023-01-01").glob("*.parquet"))
    assert spark.read.parquet(str(part)).columns == ["id"]


def test_an_empty_frame_replaces_a_date_too(spark, tmp_path):
    base = str(tmp_path / "layer")
    assert land_raw(spark.range(0), base, "2023-01-01") == 0
    assert land_raw(spark.range(10), base, "2023-01-02") == 10
    assert land_raw(spark.range(10).where("id < 0"), base, "2023-01-02") == 0
    assert read_layer(spark, base, "2023-01-02").columns == ["id"]


def test_the_date_stays_text_and_prunes_the_scan(spark, tmp_path):
    base = str(tmp_path / "layer")
    for date in ("2023-01-01", "2023-01-02"):
        write_layer(spark.range(4), base, date)
    one_day = partition_filter(spark.read.parquet(base), "2023-01-02")
    assert dict(one_day.dtypes)["ingest_date"] == "string"
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert len({row[0] for row in one_day.select(F.input_file_name()).distinct().collect() if "01-01/" in row[0]}) == 0


def test_landing_counts_what_was_written(spark, tmp_path):
    assert land_raw(spark.range(12), str(tmp_path / "raw"), "2023-01-01") == 12


def test_csv_in_either_encoding(spark, tmp_path):
    header, row = "RESTAURANT_ID,Item Name\n", "007,Café crème\n"
    (tmp_path / "utf8.csv").write_bytes((header + row).encode("utf-8"))
    (tmp_path / "cp1252.csv").write_bytes((header + row + "008,€uro\n").encode("cp1252"))
    utf8, cp1252 = (str(tmp_path / f"{name}.csv") for name in ("utf8", "cp1252"))
    assert csv_files.detect_encoding(spark, utf8) == "UTF-8"
    assert csv_files.detect_encoding(spark, cp1252) == "windows-1252"
    for path in (utf8, cp1252):
        first = csv_files.read_csv_source(spark, path).first()
        assert (first["restaurant_id"], first["item_name"]) == ("007", "Café crème")
    assert {row["item_name"] for row in csv_files.read_csv_source(spark, cp1252).collect()} == {"Café crème", "€uro"}


def test_csv_types_leave_ids_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text('order_id,n,name\n007,5,"say ""hi"", twice"\n008,x,\n')
    df = csv_files.read_csv_source(spark, str(tmp_path / "a.csv"), types={"order_id": "int", "n": "int"})
    assert [tuple(row) for row in df.collect()] == [("007", 5, 'say "hi", twice'), ("008", None, None)]


def csv_text(seed, newline):
    rng = random.Random(seed)
    pieces = ["a", "bc", "é", " ", "x y", "1"]

    def field():
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))
        if rng.random() < 0.5:
            return text
        inner = [text, '""', ",", newline, newline * 2, "z"]
        return '"' + "".join(rng.choice(inner) for _ in range(rng.randint(0, 5))) + '"' + rng.choice(["", "", "  "])

    lines = [",".join(field() for _ in range(rng.choice([4, 4, 4, 3, 5]))) for _ in range(rng.choice([0, 1, 60]))]
    return newline.join(["col_a,col b,c,d", *lines]) + rng.choice(["", newline])


@pytest.mark.parametrize("seed", range(6))
def test_csv_blocks_give_the_rows_of_a_whole_file(spark, tmp_path, seed):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_bytes(csv_text(seed, ["\n", "\r\n"][seed % 2]).encode())
    ordered = lambda df: sorted(map(tuple, df.collect()), key=lambda r: tuple((v is not None, v) for v in r))
    want = ordered(spark.read.csv(path, header=True, multiLine=True, escape='"'))
    for block in (24, 300, 1 << 20):
        got = csv_records.read_records(spark, path, None, "windows-1252", block=block)
        assert got.columns == ["col_a", "col b", "c", "d"] and ordered(got) == want


def test_one_csv_file_is_read_by_many_tasks_without_settings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufefforder_id,note\n" + "".join(f'{i},"line {i}\nnext"\n' for i in range(20_000)))
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll
    df = csv_files.read_csv_source(spark, str(tmp_path / "a.csv"), block=32_768)
    assert df.sparkSession is spark and df.columns == ["order_id", "note"]
    assert df.select(F.spark_partition_id()).distinct().count() > 8
    assert df.where("note = concat('line ', order_id, '\\nnext')").count() == df.count() == 20_000
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll) == before


def test_csv_files_of_a_folder_have_a_header_each(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.csv").write_text(f'\nx,x,\n"{name}\n{name}",2,3\n\n')
    (tmp_path / "in" / "c.csv").write_text('x,x,\n1,"never closed\n')
    df = csv_records.read_records(spark, str(tmp_path / "in"), None, "windows-1252")
    assert df.columns == ["x0", "x1", "_c2"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("a\na", "2", "3"), ("b\nb", "2", "3"), ("1", "never closed", None)], key=str)
    (tmp_path / "empty.csv").write_text("")
    assert csv_files.read_csv_source(spark, str(tmp_path / "empty.csv")).columns == []


@pytest.mark.parametrize(
    ("line", "inside", "after"),
    [("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('a,"b""', False, True), ('5" pipe,c', False, False),
     ('"a" ,"b', False, True), ('"a"b,"c', False, True), ("text", True, True), ('end",x', True, False), ('end"",x', True, True),
     ("", True, True), ("", False, False)],
)
def test_state_at_the_end_of_a_line(line, inside, after):
    assert csv_records.end_state(line.encode(), inside) is after


def test_staged_tables_go_with_their_scope(spark):
    with scratch.scratch_scope(spark) as folder:
        inner = scratch.stage(spark.range(3), "inner")
        kept = scratch.stage(inner.withColumn("x", F.lit(1)), "kept", outlives=True)
        assert inner.scratch_path.startswith(folder) and files.exists(spark, folder)
        scratch.discard(inner)
        assert not files.exists(spark, inner.scratch_path)
    assert not files.exists(spark, folder) and kept.count() == 3
    with pytest.raises(ValueError, match="stop"), scratch.scratch_scope(spark) as folder:
        scratch.stage(spark.range(3), "inner")
        raise ValueError("stop")
    assert not files.exists(spark, folder)


def test_missing_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.load_sources(spark, str(tmp_path))
    (tmp_path / "date_dim.csv").write_text("date_key\n01-01-2023\n")
    assert list(csv_files.load_sources(spark, str(tmp_path))) == ["date_dim.csv"]


def test_jdbc_options_for_whole_and_parallel_reads():
    whole = jdbc_options("jdbc:x", "dbo.t", "me", "pw", "a.Driver")
    assert whole["dbtable"] == "dbo.t" and "numPartitions" not in whole
    parallel = jdbc_options(
        "jdbc:x", "t", "me", "pw", "a.Driver",
        partition_column="id", lower_bound=0, upper_bound=100, num_partitions=8,
    )
    assert {key: parallel[key] for key in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError, match="numPartitions"):
        jdbc_options("jdbc:x", "t", "me", "pw", "a.Driver", partition_column="id")


def test_tables_report_one_date(spark, tmp_path):
    mart = spark.createDataFrame(
        [("Bowls", "Rice", 5, 2, 3, 1)],
        "item_category string, item_name string, net_revenue int, total_item_quantity int, "
        "line_item_count int, avg_net_revenue_per_line int",
    )
    base = str(tmp_path / "item_sales")
    write_layer(mart, base, "2023-01-01")
    catalog.register_tables(spark, "tallyhouse_test", {"item_sales": base})
    assert [row[0] for row in catalog.show_tables(spark, "tallyhouse_test").collect()] == ["item_sales"]
    # a date written later is added, or found when the table is registered again
    write_layer(mart.unionByName(mart), base, "2023-01-02")
    catalog.add_date(spark, "tallyhouse_test", ["item_sales"], "2023-01-02")
    assert reports.report_on_tables(spark, "tallyhouse_test", "top_items", "2023-01-02").count() == 2
    catalog.register_tables(spark, "tallyhouse_test", {"item_sales": base})
    assert reports.report_on_tables(spark, "tallyhouse_test", "top_items", "2023-01-01").count() == 1
    assert reports.report_on_tables(spark, "tallyhouse_test", "top_items", "2023-01-02").count() == 2


def test_staging_follows_the_session_and_cuts_lineage(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == root
    staged = scratch.stage(spark.range(5).withColumn("x", F.rand()), "numbers")
    assert by(staged, "id") == by(staged, "id")
    assert all(path.startswith(f"file://{root}") for path in staged.inputFiles())
