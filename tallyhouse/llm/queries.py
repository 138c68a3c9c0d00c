"""Each operator as a query over whole tables, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, chat, codes, embdedup, jaccard, langid, leaks, licenses, lm, neighbours, quality, toxicity, trie
from tallyhouse.llm.tables import remainder, table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found for every vector whose id is divisible by 50."""
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text; digests of the ids and of the decoded text."""
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents from the counts of all others."""
    scored = lm.scores(table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", "n_words", F.round("log10_score", 4).alias("log10_score"), F.round("mean_log10", 6).alias("mean_log10")
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.collapse(table(spark, sf_dir, "conversations"))


def _to_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the rows to learn from."""
    return table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)


def _held_out(modulus: int, rest: int):
    return F.coalesce(remainder(F.col("doc_id"), modulus) == rest, F.lit(False)).alias("held_out")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = quality.rate(docs, quality.fit(docs, _to_learn(spark, sf_dir)))
    return rated.select("doc_id", _held_out(5, 0), "score", "predicted")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(remainder(F.col("doc_id"), 4) != 2))
    named = langid.identify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", _held_out(4, 2), "lang_pred", "score", "ambiguous")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = toxicity.rate(docs, toxicity.fit(docs, _to_learn(spark, sf_dir)))
    return rated.select("doc_id", _held_out(5, 0), "score", "predicted")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents, with coverage and spans."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of the rebuilt conversations."""
    return trie.shared_heads_trie(table(spark, sf_dir, "conversations"))


def op12_embdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate vectors of one label."""
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_bpe": op2_bpe,
    "op3_lm": op3_lm,
    "op4_chat": op4_chat,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_leaks": op10_leaks,
    "op11_trie": op11_trie,
    "op12_embdedup": op12_embdedup,
    "op13_codes": op13_codes,
}

ORACLES: dict[str, str] = {
    "op3_lm": lm.ORACLE,
    "op4_chat": chat.ORACLE,
    "op11_trie": trie.ORACLE,
    "op12_embdedup": embdedup.ORACLE,
    "op13_codes": codes.oracle(),
}
