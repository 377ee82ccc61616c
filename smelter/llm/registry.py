"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smelter.llm import (
    conversation_repair,
    conversation_trie,
    decontamination,
    language_ecoc,
    line_dedup,
    pieces,
    quality_nbsvm,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    topk_segments,
    toxicity,
    warc,
)
from smelter.llm.common import table


def __getattr__(name: str) -> str:
    """VOCABULARY, the path of the tokenizer's file, is looked up when a query asks for it."""
    if name == "VOCABULARY":
        import public_tokenizers

        return public_tokenizers.path("piece_bpe_32k.model")
    raise AttributeError(name)


def op1_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_nbsvm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_topk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_segments.hundredths(table(spark, sf_dir, "embeddings"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(table(spark, sf_dir, "documents"), __getattr__("VOCABULARY"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.words_digest(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.cluster_digest(table(spark, sf_dir, "documents"))


def op8_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_ecoc.identify(docs, language_ecoc.fit(docs))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_duplicated(table(spark, sf_dir, "documents"), digest=True)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records_back(table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_quality_nbsvm, op2_topk_segments, op3_sentencepiece, op4_decontamination, op5_substring_dedup, op6_toxicity, op7_simhash_dedup, op8_language_ecoc, op9_suffix_dedup, op10_line_dedup,
    op11_warc, op12_conversation_repair, op13_conversation_trie)}
ORACLE = {"op2_topk_segments": topk_segments.SEARCH_SQL, "op5_substring_dedup": substring_dedup.DIGEST_SQL, "op9_suffix_dedup": suffix_dedup.DIGEST_SQL,
          "op10_line_dedup": line_dedup.DIGEST_SQL, "op11_warc": warc.PAGES_SQL, "op13_conversation_trie": conversation_trie.TRIE_SQL}
