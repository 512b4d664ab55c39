"""Connected components of a link table by contraction, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import session


def twice(points: DataFrame) -> DataFrame:
    """Where each node gets by following ``points`` twice."""
    onward = points.select(F.col("u").alias("to"), F.col("to").alias("then"))
    return points.join(onward, "to").select("u", F.col("then").alias("to"))


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` for every node in ``links (u, v)``; nodes have the same label iff links connect them.

    Each round points every node to the neighbour (or itself) that comes first, follows these pointers four times, and
    replaces nodes by what they get to. The first round goes by the ids, which settles stars around a smallest node at once; later ones draw a new
    order, which takes away a constant share of the nodes of any graph, hubs and long paths included. Every round is
    stored, so a lost executor costs a read.
    """
    edges = session.cut(links.where("u <> v").select("u", "v").distinct(), "links")
    steps, rank = [], 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        order = (lambda node: F.struct(F.lit(0).alias("o"), F.col(node).alias("n"))) if not rank else (
            lambda node: F.struct(F.xxhash64(node, F.lit(rank)).alias("o"), F.col(node).alias("n")))
        points = both.groupBy("u").agg(F.min(order("v")).alias("near")).select(
            "u", F.least("near", order("u"))["n"].alias("to"))
        points = session.cut(points, "link-points")
        points = session.cut(twice(twice(points)), "link-points")
        steps.append(points)
        ends = points.select(F.col("u").alias("v"), F.col("to").alias("q"))
        moved = edges.join(points, "u").join(ends, "v").where("to <> q").select(
            F.least("to", "q").alias("u"), F.greatest("to", "q").alias("v"))
        edges = session.cut(moved.distinct(), "links")
        rank += 1
    if not steps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    labels = steps[0].select(F.col("u").alias("node"), F.col("to").alias("label"))
    for points in steps[1:]:
        labels = labels.join(points, F.col("label") == F.col("u"), "left").select(
            "node", F.coalesce("to", "label").alias("label"))
    return session.cut(labels, "link-labels")
