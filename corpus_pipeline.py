"""The corpus pipeline: documents in five stages, each an operator of `annalist.llm` over all that the one before kept.

A document goes if it looks like no language or holds a benchmark item; of near duplicates one stays; repeated lines
go; what is left is encoded. All but the last stage return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import bpe, decontaminate, language_id, line_dedup, simhash
from annalist.llm.common import Scratch, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no letter (`und`) or unlike every learned language."""
    return language_id.filter_languages(spark, docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines that many documents repeat; n_chars follows the text."""
    out = line_dedup.dedup_lines(spark, docs).drop("n_lines", "n_dropped")
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the smallest doc_id."""
    return simhash.keep_first(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text to ids, and digests the ids and their decoding."""
    out = bpe.encode_documents(docs.select("doc_id", "text"), with_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
#: Rank-order language profiles, fingerprints and BPE are beyond SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written as Parquet and read again by the next."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}-{name}")
        if k:
            scratch.drop(f"stage-{k - 1}-{STAGES[k - 1][0]}")
    return docs
