"""A corpus pipeline: toxic documents go, then exact and near copies, then benchmark passages; the rest is encoded.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. Between stages the documents are
written as Parquet to the shared folder and read again, so a lost executor costs no more than a read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm import decontaminate, exact_dedup, near_dedup, pieces, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose verdict of the classifier chain stays below the limit."""
    labels = session.configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs.select("doc_id", "text"), labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    session.configure(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    session.configure(spark)
    return near_dedup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = session.configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_pieces, round_trip, piece_ids`` of what is left."""
    session.configure(spark)
    kept = docs.select("doc_id", "lang", "source", "text")
    found = pieces.encode_pieces(kept, os.path.join(pieces.TOKENIZERS, "piece_bpe_32k.model"), round_trip="round_trip")
    return found.select("doc_id", "lang", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip",
                        "piece_ids")


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", encoded),
]

# A trained classifier, confirmed similarity and piece ids have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    session.configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = session.cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
