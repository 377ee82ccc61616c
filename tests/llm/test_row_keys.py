"""Rows without an id whose texts share a 32-bit hash are told apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from smelter.llm import substring_dedup, suffix_dedup

COMMON = " ".join(f"word{i}" for i in range(60))


def test_texts_with_one_32_bit_hash_and_no_id(spark):
    made = spark.range(400_000).select(F.concat(F.lit(COMMON + " "), F.repeat(F.lit("tail "), (F.col("id") % 40).cast("int")), F.col("id").cast("string")).alias("text"))
    pair = made.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("texts"), F.max(F.length("text")).alias("a"), F.min(F.length("text")).alias("b"))
    first, second = pair.where("size(texts) > 1 AND a <> b").first().texts[:2]
    docs = spark.createDataFrame([(1, COMMON), (None, first), (None, second)], "doc_id long, text string")
    words = {(r.n_words, r.n_removed) for r in substring_dedup.words_digest(docs).collect()}
    assert words == {(60, 0), (len(first.split()), 60), (len(second.split()), 60)}
    parts = {(r.n_bytes, r.n_removed) for r in suffix_dedup.remove_duplicated(docs, digest=True).collect() if r.doc_id is None}
    assert len(parts) == 2 and all(removed >= len(COMMON) for _, removed in parts)
