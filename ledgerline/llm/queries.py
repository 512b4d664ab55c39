"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm import (
    alignment, decontaminate, exact_dedup, near_dedup, passages, pieces, pitman_yor, quality, secret_scan, sharding,
    token_counts, toxicity, whitening,
)

SHARDS = 40


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_exact_duplicates(_documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(_documents(spark, sf_dir), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, chain).drop("text")
    return scored.select("doc_id", "toxicity.*", (F.col(f"toxicity.{toxicity.VERDICT}") >= toxicity.LIMIT).alias("rejected"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_documents(spark, sf_dir))


def op5_sentencepiece(spark: SparkSession, sf_dir: str, tokenizers: str = pieces.TOKENIZERS) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    encoded = pieces.encode_pieces(docs, os.path.join(tokenizers, "piece_bpe_32k.model"), round_trip="round_trip")
    return encoded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip", "piece_ids")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str, tokenizers: str = pieces.TOKENIZERS) -> DataFrame:
    ranks = os.path.join(tokenizers, "byte_bpe_50k.tiktoken")
    docs = token_counts.with_trees(_documents(spark, sf_dir).select("doc_id", "text"), ranks)
    docs = token_counts.with_edited_trees(token_counts.with_redactions(docs), ranks)
    return docs.select(
        "doc_id", F.element_at("tree.sums", 2).cast("long").alias("n_tokens"), F.size("edits").alias("n_edits"),
        F.col("edited.tokens").alias("n_tokens_edited"), F.col("edited.encoded").alias("chars_encoded_again"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.described(_documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    docs = session.cut(docs, "quality-statistics")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, into="score")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(_documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = pieces.TOKENIZERS) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir), os.path.join(tokenizers, "byte_bpe_50k.json"),
                           os.path.join(tokenizers, "piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_sharding": op6_sharding,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_counts": op8_token_counts,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}

CHECKS = {
    "op1_exact_dedup": """
        with normal as (
            select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) as text_sha256
            from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, text_sha256
        from normal window same as (partition by text_sha256)""",
}
