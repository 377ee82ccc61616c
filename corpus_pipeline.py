"""The corpus pipeline over ``documents``; each stage applies one operator to all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of their input; nulls, repeated rows and empty tables are as the operators
state. The stages take their decisions on whole texts as the stage before left them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from smelter.llm import decontamination, line_dedup, near_copies, pieces, quality_nbsvm, registry
from smelter.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score is 0.3 or more; fitted on the raw documents' labels outside the held-out fold."""
    return quality_nbsvm.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, lines that five documents or more hold kept in the largest doc_id only."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that pairs of five-word Jaccard similarity 0.8 or more connect: the smallest doc_id. Found by
    SimHash's index, count filter and bit check, verified on the whole sets, and completed by prefix filtering."""
    return near_copies.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item within its edit budget."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their digests, and the digest of the decoded text."""
    return pieces.encode_decode(docs, registry.VOCABULARY, keep_text=False)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]
ORACLE_SQL = None  # a trained model, XXH64 and a tokenizer; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's table lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
