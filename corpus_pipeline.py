"""A training corpus from the documents table, in five stages.

Each stage works on all rows its predecessor kept, written as Parquet and read
again. All but the last return the columns of documents; the last returns one
row of token ids, as hashes, for every pass of a document in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import bpe, common, language, mixing, simhash, suffix


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no text, no letter, or a score below the fit's bound."""
    return language.accepted_rows(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that start in a document with a smaller id are cut out."""
    return suffix.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and in the order, that the curriculum takes them."""
    return mixing.sequenced(docs, mixing.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix, encoded."""
    return bpe.encode(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("mixing sources", source_mixing),
    ("BPE encoding", token_ids),
]

#: SQL can state neither the classifier nor the fingerprints nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
