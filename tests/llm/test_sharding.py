from __future__ import annotations

import zlib

import pytest
from corpora import corpus, edge_rows, edge_table, table
from pyspark.sql import functions as F

from ledgerline.llm import sharding


def walked(spark, docs, shards, points, slack=0.0):
    """Brute force: every key walks the ring by itself, in rounds, the first of an arc first."""
    nodes = sharding.ring_points(spark, shards, points)
    keyed = docs.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("p")).collect()
    cells = [cell for cell, _ in nodes]
    room = sharding.capacities(len(keyed), shards, slack)
    arcs = [next((i for i, cell in enumerate(cells) if cell >= row.p >> 47), 0) for row in keyed]
    wraps = [row.p >> 47 > cells[-1] for row in keyed]
    order = sorted(range(len(keyed)), key=lambda i: (arcs[i], not wraps[i], keyed[i].p))
    walks = {arc: list(dict.fromkeys(nodes[(arc + k) % len(nodes)][1] for k in range(len(nodes)))) for arc in set(arcs)}
    found, step = {}, 0
    while len(found) < len(keyed):
        for i in order:
            if i not in found and room[walks[arcs[i]][step]]:
                room[walks[arcs[i]][step]] -= 1
                found[i] = walks[arcs[i]][step]
        step += 1
    return {keyed[i].doc_id: shard for i, shard in found.items()}


@pytest.mark.parametrize(("shards", "points"), [(7, 4), (40, 64), (1, 1)])
def test_every_key_goes_where_its_walk_leads(spark, shards, points):
    docs = table(spark, corpus())
    got = {row.doc_id: row.shard for row in sharding.shard_rows(docs, shards, points).collect()}
    assert got == walked(spark, docs, shards, points)


def check(rows, got, shards):
    counts = [0] * shards
    slots = [set() for _ in range(shards)]
    for row in got:
        counts[row.shard] += 1
        slots[row.shard].add(row.slot)
    assert sum(counts) == len(rows) == len(got)
    assert max(counts) - min(counts) <= 1
    assert all(slots[k] == set(range(counts[k])) for k in range(shards))


def test_edge_cases(spark):
    rows = edge_rows()
    got = sharding.shard_rows(edge_table(spark), 6).collect()
    check(rows, got, 6)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((text or "").encode()) + 16, zlib.crc32((text or "").encode())) for i, text, *_ in rows)
    assert sharding.shard_rows(edge_table(spark, []), 6).collect() == []


def test_one_id_may_hold_most_rows(spark):
    rows = [(7, f"text {i % 3}", None, None, None) for i in range(3000)] + corpus()
    docs = table(spark, rows).repartition(8)
    check(rows, sharding.shard_rows(docs, 40).collect(), 40)


def test_slack_keeps_more_keys_at_home_when_a_shard_is_added(spark):
    docs = table(spark, [(i, "x", None, None, None) for i in range(4000)])

    def moved(slack):
        one, two = ({row.doc_id: row.shard for row in sharding.shard_rows(docs, n, slack=slack).collect()} for n in (20, 21))
        return sum(one[k] != two[k] for k in one)

    assert moved(0.5) < 4000 * 0.12
    assert moved(0.5) <= moved(0.0)
