"""Consistent-hash sharding with virtual nodes and bounded loads, in built-in functions only.

Each shard owns ``points`` virtual nodes on a ring of ``CELLS`` cells; a key belongs to the first node at or after its
cell. A full shard passes what is left of an arc on, clockwise, to the next shard that is not full, the arc's first keys
staying. Capacities add up to the number of rows when ``slack`` is 0, so shards differ by one row at most.

Keys are sorted once along the ring by a range shuffle whose bounds may also fall between equal keys, so that an id that
fills a third of all rows is spread as well. What passes through the driver is a count per arc and partition.

Null ids hash like a value of their own; a null text counts as empty; equal rows get slots of their own. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session

CELLS = 1 << 16
OVERHEAD_BYTES = 16


def ring_points(spark: SparkSession, shards: int, points: int) -> list[tuple[int, int]]:
    """``(cell, shard)`` of every virtual node in ring order; of nodes on one cell the smallest shard's counts."""
    nodes = spark.range(shards * points).select(
        F.pmod(F.xxhash64(F.floor(F.col("id") / points), F.col("id") % points), F.lit(CELLS)).alias("cell"),
        F.floor(F.col("id") / points).alias("shard"))
    nodes = nodes.groupBy("cell").agg(F.min("shard").alias("shard"))
    return sorted((row.cell, row.shard) for row in nodes.collect())


def arc_shares(counts: list[int], homes: list[int], capacity: list[int]) -> list[list[tuple[int, int]]]:
    """Per arc, ``(shard, rows)`` in ring order: who takes how many of the arc's rows.

    ``homes[i]`` is the shard of the node that ends arc ``i``. In each round every arc offers what it has left to the
    next distinct shard clockwise; it costs arcs times shards steps, whatever the number of rows.
    """
    arcs, room = len(homes), list(capacity)
    left, shares, at = list(counts), [[] for _ in counts], list(range(arcs))
    tried: list[set[int]] = [set() for _ in counts]
    waiting = [arc for arc in range(arcs) if left[arc]]
    while waiting:
        for arc in waiting:
            while homes[at[arc] % arcs] in tried[arc]:
                at[arc] += 1
            shard = homes[at[arc] % arcs]
            tried[arc].add(shard)
            taken = min(room[shard], left[arc])
            if taken:
                room[shard] -= taken
                left[arc] -= taken
                shares[arc].append((shard, taken))
        waiting = [arc for arc in waiting if left[arc]]
    return shares


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may hold: counts at most one apart, plus ``slack`` of the mean."""
    extra = int(slack * rows / shards)
    return [rows // shards + (shard < rows % shards) + extra for shard in range(shards)]


def _literal_table(spark: SparkSession, rows: Iterable[dict], schema: str) -> DataFrame:
    parsed = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(parsed).alias("row")).select("row.*")


def shard_rows(docs: DataFrame, shards: int, points: int = 64, slack: float = 0.0, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, shard, slot``; slots of a shard run from 0 without a gap."""
    spark = docs.sparkSession
    filled: Column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(filled) + F.lit(OVERHEAD_BYTES)).cast("long").alias("size"),
        F.crc32(filled.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(F.col(f"`{doc_id}`")), 1).alias("position"),
        F.monotonically_increasing_id().alias("tag"))
    keyed = session.cut(keyed, "shard-keys")
    order = ["position", "doc_id", "size", "text_crc32", "tag"]
    along = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = ring_points(spark, shards, points)
    arcs = _literal_table(
        spark, ({"arc": arc, "low": low, "high": high} for arc, low, high in _spans([cell for cell, _ in nodes])),
        "arc int, low int, high int")
    arc_of_cell = arcs.select("arc", F.explode(F.sequence("low", "high")).alias("cell"))
    placed = along.withColumn("at", F.monotonically_increasing_id()).withColumn(
        "cell", F.shiftright("position", 47).cast("int"))
    placed = placed.join(F.broadcast(arc_of_cell), "cell").select(
        "doc_id", "size", "text_crc32", "arc", F.shiftright("at", 33).cast("int").alias("part"),
        F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"))
    placed = session.cut(placed, "shard-order")
    counted = placed.groupBy("part", "arc").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    groups = sorted((row.part, row.first, row.arc, row.n) for row in counted.collect())
    pieces = _literal_table(spark, _pieces(groups, [shard for _, shard in nodes], shards, slack),
                            "part int, arc int, low long, high long, shard int, base long")
    return placed.join(F.broadcast(pieces), ["part", "arc"]).where("nth >= low and nth < high").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("nth")).alias("slot"))


def _spans(cells: list[int]) -> Iterable[tuple[int, int, int]]:
    """``(arc, first cell, last cell)``; the cells after the last node are a last arc that wraps to the first."""
    low = 0
    for arc, cell in enumerate(cells):
        yield arc, low, cell
        low = cell + 1
    if low < CELLS:
        yield len(cells), low, CELLS - 1


def _pieces(groups: list[tuple[int, int, int, int]], homes: list[int], shards: int, slack: float) -> Iterable[dict]:
    """Which stretch of each partition goes to which shard, and at which slot it begins."""
    arcs = len(homes)
    counts = [0] * arcs
    # the wrapping arc's rows come last along the ring but are the first node's, before those of arc 0
    ring = sorted(groups, key=lambda group: (group[2] % arcs, group[2] != arcs, group[0], group[1]))
    for _, _, arc, n in ring:
        counts[arc % arcs] += n
    shares = [list(share) for share in arc_shares(counts, homes, capacities(sum(counts), shards, slack))]
    filled = [0] * shards
    for part, first, arc, n in ring:
        share = shares[arc % arcs]
        while n:
            shard, room = share[0]
            taken = min(room, n)
            yield {"part": part, "arc": arc, "low": first, "high": first + taken, "shard": shard,
                   "base": filled[shard] - first}
            filled[shard] += taken
            first, n = first + taken, n - taken
            share[0] = (shard, room - taken)
            if room == taken:
                share.pop(0)
