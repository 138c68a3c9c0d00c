"""Stages of the corpus pipeline against plain versions, with awkward rows and clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute

CLASH = ("score", "reject", "lang_pred", "unsure", "set_id", "again", "leaking_doc", "row", "key", "label", "ids")


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.col("doc_id").cast("string") for c in CLASH}).repartition(5)


def folder(spark, tmp_path, labels, benchmark):
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def unlinked(rows):
    """Rows that stay, by comparing all texts: the smallest id of each group, one row of each id and group."""
    groups = brute.jaccard_components([(n if doc is not None else None, text) for n, (doc, text) in enumerate(rows)])
    component = {n: c for n, _, c in groups if n is not None}
    members = {}
    for n, (doc, text) in enumerate(rows):
        if doc is not None and brute.shingle_set(text):
            members.setdefault(component[n], []).append((doc, n))
    chosen = {min(m)[0] for m in members.values()}
    return chosen, members


def test_near_duplicates_keep_one_of_each_group_and_unrelated_texts(spark, tmp_path):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(80):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = [rng.choice(vocabulary) if rng.random() < 0.01 else w for w in base]
            rows.append((rng.randint(0, 150), " ".join(copy)))  # some ids stand on several rows
    rows += rows[:3] + [(None, rows[0][1]), (None, None), (7, None), (8, ""), (9, "x" * 200_000)]
    got = pairs(corpus_pipeline.drop_near_duplicates(spark, documents(spark, [(*r, "aa") for r in rows]), str(tmp_path)))
    chosen, members = unlinked(rows)
    plain = [r for r in got if r[0] is not None and brute.shingle_set(r[1])]
    text_group = {}
    for group, found in members.items():
        for _, n in found:
            text_group[rows[n][0], rows[n][1]] = group
    kept = {}
    for r in plain:
        kept.setdefault(text_group[r], []).append(r[0])
    assert kept == {group: [min(found)[0]] for group, found in members.items()}
    rest = [r for r in rows if r[0] is None or not brute.shingle_set(r[1])]
    assert sorted(map(str, rest)) == sorted(str(r) for r in got if r not in plain)
    assert chosen == {r[0] for r in plain}


def test_a_copy_and_an_unrelated_text_under_one_id(spark, tmp_path):
    first, other = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = documents(spark, [(1, first, "aa"), (2, first, "aa"), (2, other, "aa"), (2, other, "aa"), (3, "c d e f g h", "aa")])
    out = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert pairs(out) == [(1, first), (2, other), (3, "c d e f g h")]


def test_decontamination_is_the_plain_rule(spark, tmp_path):
    rng = random.Random(3)
    item = [f"q{i}" for i in range(20)]
    rows, want = [(1, None, "aa"), (2, "", "aa"), (None, " ".join(item), "aa")], {1, 2}
    for doc in range(10, 90):
        changed = [rng.random() < 0.25 for _ in item]
        rows.append((doc, " ".join(["pad"] * 5 + [f"z{i}" if c else w for i, (c, w) in enumerate(zip(changed, item, strict=True))]), "aa"))
        if not brute.leaks(changed):
            want.add(doc)
    where = folder(spark, tmp_path, [], [(1, " ".join(item)), (2, None)])
    docs = documents(spark, rows)
    out = corpus_pipeline.drop_leaks(spark, docs, where)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == want


@pytest.mark.parametrize("step", [s for _, s in corpus_pipeline.STAGES])
def test_empty_tables_and_awkward_rows(spark, tmp_path, step):
    where = folder(spark, tmp_path, [], [])
    empty = documents(spark, [])
    assert step(spark, empty, where).count() == 0
    rows = [(1, None, None), (2, "", "aa"), (None, "a few words here", "aa"), (4, "same text", "bb"), (4, "same text", "bb")]
    out = step(spark, documents(spark, rows), where)
    assert out.count() <= len(rows)
    if step is not corpus_pipeline.encode:
        assert out.columns == empty.columns
        assert all(r["score"] in (None, str(r["doc_id"])) for r in out.collect())
