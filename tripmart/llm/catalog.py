"""The numbered queries over the driver's tables, with production parameters."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (bpe, embeddings, fim, importance, lm, minhash, mixing, oracle, quality, rules, sharding, tokenfile,
                          toxicity, weighted)
from tripmart.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file() -> str:
    """The vocabulary file of the queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).drop("source")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfile.fresh_path(spark)
    tokenfile.write(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return tokenfile.read(spark, path, with_ids=False).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link(table(spark, sf_dir, "embeddings"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transform(table(spark, sf_dir, "documents"), with_output=False)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.compare(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    pipeline, op1_bpe, op2_context_tree, op3_mixing, op4_token_files, op5_toxicity, op6_sharding, op7_quality, op8_host_rules,
    op9_embeddings, op10_minhash, op11_fim, op12_importance, op13_weighted_sampling)}


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    return {name: _prepared(q) for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
