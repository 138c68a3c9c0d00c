"""Raw documents to token ids: filter, deduplicate, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of their input. `run` writes each stage's rows as Parquet and reads them again.

Null and empty texts are never toxic, have no language and so go in the second stage. Rows
without doc_id are kept by the stages that compare documents. An id that stands on several rows is
decided row by row: unrelated texts stay, of equal or linked ones under one id one stays. Extra columns
pass through whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, jaccard, langid, leaks, toxicity
from tallyhouse.llm.queries import tokenizer_path
from tallyhouse.llm.tables import remainder, table
from tallyhouse.sources.scratch import stage


def _names(docs: DataFrame, *wanted: str) -> tuple[str, ...]:
    """Names for further columns that no column of the documents bears, in any letter case."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in wanted:
        while name in taken:
            name += "_"
        found.append(name)
    return tuple(found)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones, does not reject."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    score, reject = _names(docs, "score", "reject")
    rated = toxicity.rate(docs, model, names=(score, reject))
    return rated.where(F.col(reject) == 0).select(*docs.columns)


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and not ambiguous."""
    model = langid.fit(docs.where(remainder(F.col("doc_id"), 4) != 2))
    lang, score, unsure = _names(docs, "lang_pred", "score", "unsure")
    named = langid.identify(docs, model, names=(lang, score, unsure))
    return named.where((F.col(lang) != langid.UNKNOWN) & ~F.col(unsure)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near duplicates."""
    return jaccard.first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

ORACLE_SQL = None  # models and tokenizers; tests/llm/test_pipeline.py compares stages with brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
