"""Registered corpus queries on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from tallyhouse.llm.queries import ORACLES, QUERIES
from tests.support.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op1_neighbours", "op9_licenses", "op10_leaks"}))
def test_one_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert QUERIES[name](spark, FOLDER).count() == documents


def test_pipeline_keeps_a_part_of_the_documents(spark):
    kept = corpus_pipeline.run(spark, FOLDER)
    ids = {r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    found = [r["doc_id"] for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) < ids
