"""Membership filters over hashes, and removing a minority of wide rows without moving the others.

A blocked Bloom filter is a table ``word -> bits``: a hash picks one 64-bit word and three of its bits. The table
has at most ``words`` rows at any size of input, which bounds what is broadcast; a fuller filter only lets more
rows through to the exact step that always follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_WORDS = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else; null counts as empty."""
    filled = F.coalesce(text, F.lit(""))
    plain = F.length(filled) == F.octet_length(filled)
    return F.when(plain, F.lower(filled)).otherwise(F.translate(filled, UPPER, LOWER))


def _word(hashed: Column, words: int) -> Column:
    return F.pmod(F.shiftrightunsigned(hashed, 18), F.lit(words))


def _mask(hashed: Column) -> Column:
    bits = [F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(63)).cast("int") for shift in (0, 6, 12)]
    one, two, three = (F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in bits)
    return one.bitwiseOR(two).bitwiseOR(three)


def bloom_of(hashes: DataFrame, column: str, words: int = FILTER_WORDS, repeated: bool = False) -> DataFrame:
    """The filter ``(filter_word, filter_bits)`` of ``column``; with ``repeated``, of values that occur twice or more.

    Equal cells are counted before they are merged, so a value that fills a third of the rows is one row per task.
    """
    cells = hashes.select(_word(F.col(column), words).alias("filter_word"), _mask(F.col(column)).alias("mask"))
    cells = cells.groupBy("filter_word", "mask").agg(F.count(F.lit(1)).alias("n"))
    if repeated:
        cells = cells.where("n > 1")
    return cells.groupBy("filter_word").agg(F.bit_or("mask").alias("filter_bits"))


def probe(df: DataFrame, hashed: Column, bloom: DataFrame, flag: str, words: int = FILTER_WORDS) -> DataFrame:
    """``df`` with the boolean ``flag``: false only where the hash is certainly not in the filter."""
    marked = df.withColumns({f"{flag}_word": _word(hashed, words), f"{flag}_mask": _mask(hashed)})
    bloom = bloom.select(F.col("filter_word").alias(f"{flag}_word"), F.col("filter_bits").alias(f"{flag}_bits"))
    found = F.coalesce(F.col(f"{flag}_bits").bitwiseAND(F.col(f"{flag}_mask")) == F.col(f"{flag}_mask"), F.lit(False))
    joined = marked.join(F.broadcast(bloom), f"{flag}_word", "left").withColumn(flag, found)
    return joined.drop(f"{flag}_word", f"{flag}_mask", f"{flag}_bits")


def row_key(doc_id: Column, text: Column) -> Column:
    """A 96-bit key of a document row; rows that agree in id and text share it."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.hash(text, doc_id).alias("b"))


def without_rows(docs: DataFrame, doomed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``doomed`` lists by key.

    ``doomed`` has ``a, b`` of :func:`row_key` and ``only_one``: false removes every row of that key, true keeps one
    of several equal rows. Only rows that a Bloom filter of the keys lets through are shuffled.
    """
    names = docs.columns
    wide = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"))
    wide = wide.withColumn("key", row_key(F.col(f"row.`{doc_id}`"), F.col(f"row.`{text}`")))
    marked = probe(wide, F.col("key.a"), bloom_of(doomed, "a"), "maybe")
    through = marked.where(~F.col("maybe")).select("row")
    listed = doomed.groupBy(F.struct("a", "b").alias("key")).agg(F.min("only_one").alias("only_one"))
    met = marked.where("maybe").select("key", "row").join(listed, "key", "left")
    spared = met.where("only_one is null").select("row")
    single = met.where("only_one").groupBy("key").agg(F.any_value("row").alias("row")).select("row")
    return through.unionByName(spared).unionByName(single).select("row.*")
