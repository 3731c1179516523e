"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duolog.llm import embedding_dedup, exact_dedup, language_id, licenses, mixing, ngram_join, packing, prefix_trie, quality, toxicity, warc, whitening, word_bpe


def vocabulary_path() -> str:
    """The public vocabulary file of the packing and encoding queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), width=5, percent=80)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary_path(), capacity=4096, end_id=1)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.code_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), modulus=3, held_out=1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), modulus=5, held_out=0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"), modulus=4, held_out=2)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), stride=20, most=4)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.repetitions(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share="3/2", epochs=2)
    return plan.select("doc_id", "size", "source_size", "target", "taken", "repetitions")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=4, scale=256)


def queries() -> dict:
    return {f.__name__: f for f in (op1_exact_dedup, op2_ngram_join, op3_packing, op4_warc, op5_word_bpe, op6_licenses, op7_embedding_dedup, op8_quality, op9_toxicity, op10_language_id, op11_prefix_trie, op12_mixing, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.ORACLE, "op6_licenses": licenses.oracle()}
