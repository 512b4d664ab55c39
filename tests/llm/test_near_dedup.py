from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from corpora import corpus, edge_rows, edge_table, edited, sentence, table

from ledgerline.llm import components, near_dedup
from ledgerline.llm.wordhash import Splitter

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def roots(sets):
    """Component root of each row by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            common = len(one & sets[j])
            if common and 100 * common >= 75 * len(one | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("seed", [5, 6])
def test_components_like_all_pairs(spark, seed):
    rows = corpus(seed)
    sets = [shingles(text) for _, text, *_ in rows]
    got = {row.doc_id: row for row in near_dedup.near_duplicates(table(spark, rows)).collect()}
    for i, root in enumerate(roots(sets)):
        assert got[i].n_shingles == len(sets[i])
        assert (got[i].component_id, got[i].kept) == (root, root == i)


def test_a_large_family_below_and_above_the_limit(spark):
    rng = random.Random(2)
    base = sentence(rng, 120)
    texts = [edited(rng, base, rng.choice((1, 2, 3, 4))) for _ in range(60)]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    got = {row.doc_id: row.component_id for row in near_dedup.near_duplicates(table(spark, rows)).collect()}
    assert [got[i] for i in range(60)] == roots([shingles(text) for text in texts])


def test_edge_cases(spark):
    rows = edge_rows()
    got = near_dedup.near_duplicates(edge_table(spark)).collect()
    sets = [shingles(text) for _, text, *_ in rows]
    assert sorted(row.n_shingles for row in got) == sorted(map(len, sets))
    # the contract's rule: all rows of the smallest id, however often it is repeated
    assert all(row.kept == (row.doc_id == row.component_id) for row in got)
    assert all(row.component_id == row.doc_id and row.kept for row in got if row.n_shingles == 0)
    kept = near_dedup.drop_near_duplicates(edge_table(spark))
    assert kept.columns == edge_table(spark).columns
    families = {root for root, one in zip(roots(sets), sets, strict=True) if one}
    # of rows equal in id and text one stays, also when they have no words
    blank = {(row[0], row[1]) for row, one in zip(rows, sets, strict=True) if not one}
    texts = [row.text for row in kept.collect()]
    assert sum(bool(shingles(text)) for text in texts) == len(families)
    assert len(blank) <= sum(not shingles(text) for text in texts) <= sum(not one for one in sets)


def test_drop_keeps_the_smallest_id(spark):
    rows = corpus(seed=8)
    kept = {row.doc_id for row in near_dedup.drop_near_duplicates(table(spark, rows)).collect()}
    assert kept == set(roots([shingles(text) for _, text, *_ in rows]))


def test_empty_table(spark):
    assert near_dedup.near_duplicates(edge_table(spark, [])).collect() == []
    assert near_dedup.drop_near_duplicates(edge_table(spark, [])).collect() == []


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    orders = near_dedup.bin_orders()
    for size, shared in ((8, 6), (60, 50), (2000, 1700)):
        agree = []
        for _ in range(60):
            values = rng.integers(0, 1 << 63, size=2 * size - shared, dtype=np.uint64) * np.uint64(2)
            one, two = np.unique(values[:size]), np.unique(values[size - shared:])
            agree.append((near_dedup.signature(one, orders) == near_dedup.signature(two, orders)).mean())
        assert abs(np.mean(agree) - shared / (2 * size - shared)) < 0.06


def test_words_across_blocks():
    splitter = Splitter()
    rng = random.Random(4)
    texts = [sentence(rng, 90_000), "", None, "x" * 600_000 + " end", " lead", "A a"]
    column = pa.array(texts)
    from ledgerline.llm.wordhash import text_buffers
    hashes, starts, lengths, bounds = splitter.words(*text_buffers(column))
    data, offsets = text_buffers(column)
    known = {}
    for i, text in enumerate(texts):
        words = WORD.findall((text or "").encode())
        own = slice(bounds[i], bounds[i + 1])
        assert [data[s:s + n].tobytes() for s, n in zip(starts[own], lengths[own], strict=True)] == words
        for word, value in zip(words, hashes[own].tolist(), strict=True):
            assert known.setdefault(word.lower(), value) == value
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("shape", ["path", "star", "clique", "random"])
def test_connected(spark, shape):
    rng = random.Random(7)
    edges = {"path": [(i, i + 1) for i in range(300)], "star": [(150, i) for i in range(300) if i != 150],
             "clique": [(i, j) for i in range(25) for j in range(i)],
             "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]}[shape]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for u, v in edges:
        if u != v:
            parent[find(u)] = find(v)
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got) == {n for u, v in edges if u != v for n in (u, v)}
    assert all((got[i] == got[j]) == (find(i) == find(j)) for i in got for j in got)


def test_rows_that_share_their_id(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1)]
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert sorted((row.doc_id, row.component_id, row.kept) for row in got) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_dedup.drop_near_duplicates(table(spark, rows)).count() == 1
