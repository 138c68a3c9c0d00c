import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import bucket_ends, sort_key, with_ntiles
from tallyhouse.sources.scratch import stage

SCHEMA = "id int, amount decimal(14,2), count bigint, day date, name string"


def python_buckets(rows, key, buckets=4):
    """ntile by definition: earlier buckets take the extra rows."""
    ordered = sorted(rows, key=key)
    size, larger = divmod(len(ordered), buckets)
    labels, start = {}, 0
    for bucket in range(1, buckets + 1):
        end = start + size + (bucket <= larger)
        labels |= {row[0]: bucket for row in ordered[start:end]}
        start = end
    return labels


def nulls_first(value):
    return (value is not None, value if value is not None else 0)


def random_rows(count, seed):
    rng = random.Random(seed)
    return [
        (
            n,
            rng.choice([None, Decimal(rng.randint(-500, 500)) / 100, Decimal("7.00"), Decimal("7.00")]),
            rng.choice([None, 1, 1, 1, 2, -3, 2**40]),
            rng.choice([None, date(1960, 1, 1) + timedelta(days=rng.randint(0, 40_000))]),
            f"{rng.choice(['u', 'ü', 'user', ''])}{n}",
        )
        for n in range(count)
    ]


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 5, 6, 7, 101])
@pytest.mark.parametrize("sample", [3, 20, 20_000])
def test_same_as_ntile(spark, count, sample):
    rows = random_rows(count, seed=count)
    df = spark.createDataFrame(rows, SCHEMA)
    rankings = {"by_amount": ["amount", "name"], "by_count": ["count", "day", "name"]}
    result = with_ntiles(df, rankings, sample=sample).collect()
    got = {column: {row["id"]: row[column] for row in result} for column in rankings}
    expected = {
        "by_amount": python_buckets(rows, lambda r: (nulls_first(r[1]), r[4].encode())),
        "by_count": python_buckets(
            rows,
            lambda r: (nulls_first(r[2]), (r[3] is not None, r[3] or date.min), r[4].encode()),
        ),
    }
    assert got == expected


@pytest.mark.parametrize("sample", [40, 20_000])
def test_same_as_ntile_with_heavy_ties(spark, sample):
    """A third of the rows hold one value."""
    df = spark.range(9_000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).cast("bigint").alias("count"),
        F.concat(F.lit("user-"), F.col("id").cast("string")).alias("name"),
    )
    staged = stage(df, "ties")
    ranked = with_ntiles(staged, {"quartile": ["count", "name"]}, sample=sample)
    window = Window.orderBy("count", "name")
    assert ranked.withColumn("plain", F.ntile(4).over(window)).where("plain <> quartile").count() == 0
    assert [row["count"] for row in ranked.groupBy("quartile").count().collect()] == [2250] * 4


def test_three_passes_at_most_whatever_the_keys(spark, monkeypatch):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.hash("id") % 1000).cast("bigint").alias("count"),
        F.concat(F.lit("a name that is long and the same for all rows "), F.col("id").cast("string")).alias("name"),
    )
    staged, passes = stage(df, "wide"), []
    agg = type(staged).agg
    monkeypatch.setattr(type(staged), "agg", lambda self, *columns: passes.append(1) or agg(self, *columns))
    ranked = with_ntiles(staged, {"quartile": ["count", "name"], "by_name": ["name"]}, sample=2_000)
    assert len(passes) <= 3
    monkeypatch.undo()
    plain = ranked.withColumn("plain", F.ntile(4).over(Window.orderBy("count", "name"))).withColumn("other", F.ntile(4).over(Window.orderBy("name")))
    assert plain.where("plain <> quartile or other <> by_name").count() == 0


def test_rows_equal_in_all_ranking_columns_share_a_bucket(spark):
    df = spark.createDataFrame([(n, None, 1, None, "same") for n in range(8)], SCHEMA)
    ranked = with_ntiles(df, {"quartile": ["count", "name"]}, sample=3)
    assert {row["quartile"] for row in ranked.collect()} == {1}


@given(st.integers(0, 10**12), st.integers(1, 12))
def test_bucket_sizes_differ_by_one_at_most(row_count, buckets):
    ends = [0, *bucket_ends(row_count, buckets), row_count]
    sizes = [high - low for low, high in zip(ends, ends[1:], strict=False)]
    assert sum(sizes) == row_count and max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.integers(-(2**63), 2**63 - 1), st.none() | st.text(max_size=6)), min_size=2, max_size=25))
def test_key_sorts_like_its_columns(spark, pairs):
    rows = [(n, None, count, None, name) for n, (count, name) in enumerate(pairs)]
    df = spark.createDataFrame(rows, SCHEMA)
    keyed = df.select("id", sort_key(df, ["count", "name"]).alias("key")).collect()
    keys = {row["id"]: row["key"] for row in keyed}

    def order(n):
        count, name = pairs[n]
        return (nulls_first(count), (name is not None, (name or "").encode("utf-8", "surrogatepass")))

    by_columns = sorted(range(len(pairs)), key=order)
    assert [keys[n] for n in by_columns] == sorted(keys.values())


def test_ranking_by_a_float_is_refused(spark):
    with pytest.raises(TypeError):
        sort_key(spark.createDataFrame([(1.0,)], "x double"), ["x"])
