"""Exact deduplication by two-pass Bloom filtering, in built-in functions only.

Pass one hashes every text and records, in a Bloom filter of bounded size, the cells hit more than once. Pass two
probes it: a row whose hash missed is alone with its text and passes straight through; only the others are shuffled
and grouped by the SHA-256 of their whole text. False positives cost a shuffled row, never a wrong result.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the row with the
largest id stays; null ids come first in that order, and of rows that agree in id and text exactly one stays. An empty
table gives an empty result. Other columns are carried along whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm.rowsets import FILTER_WORDS, bloom_of, lowered, probe


def _probed(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """``row``, ``sha`` and ``maybe``: whether the text is possibly repeated."""
    hashes = docs.select(F.xxhash64(lowered(F.col(f"`{text}`"))).alias("h"))
    wide = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    normal = lowered(F.col(f"row.`{text}`"))
    wide = wide.withColumns({"h": F.xxhash64(normal), "sha": F.sha2(normal.cast("binary"), 256)})
    return probe(wide, F.col("h"), bloom_of(hashes, "h", words, repeated=True), "maybe", words).drop("h")


def mark_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          words: int = FILTER_WORDS) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    probed = _probed(narrow, "doc_id", "text", words)
    probed = probed.select("row.doc_id", "sha", "maybe", F.monotonically_increasing_id().alias("tag"))
    stored = session.cut(probed, "exact-dedup", by="maybe")
    alone = stored.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    met = stored.where("maybe").select("doc_id", "tag", "sha")
    groups = met.groupBy("sha").agg(
        F.max(F.struct("doc_id", "tag")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    # stored, so that both sides of the join are plain and a text with very many copies can be split
    shared = met.join(session.cut(groups, "exact-groups"), "sha").select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("tag") == F.col("last.tag")).alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.unionByName(shared)


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          words: int = FILTER_WORDS) -> DataFrame:
    """``docs`` with one row per text, its own columns only."""
    probed = _probed(docs, doc_id, text, words)
    alone = probed.where("not maybe").select("row.*")
    survivors = probed.where("maybe").groupBy("sha").agg(F.max_by("row", F.col(f"row.`{doc_id}`")).alias("last"),
                                                         F.any_value("row").alias("any"))
    return alone.unionByName(survivors.select(F.coalesce("last", "any").alias("row")).select("row.*"))
