"""The training-data pipeline: quality, toxicity, near-duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and gives the rows it keeps, with the columns of
``documents``; the last one gives the encoded documents. A stage's output is written as Parquet in
the cluster's shared folder and read again as the next one's input, so a lost executor costs no more than the
stage that runs, and every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import bpe, minhash, mixing, quality, toxicity
from tripmart.llm.catalog import tokenizer_file
from tripmart.llm.common import prepare, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their site's prior reject go."""
    prepare(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    prepare(spark)
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id."""
    prepare(spark)
    return minhash.dedup(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 3 times."""
    prepare(spark)
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids, their number, and digests of the ids and of the decoded text."""
    prepare(spark)
    return bpe.encode(docs, tokenizer_file()).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("minhash_near_dedup", minhash_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: Classifiers, Poisson processes and the tokenizer can't be put as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
