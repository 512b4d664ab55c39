from __future__ import annotations

import hashlib
from collections import defaultdict

from corpora import corpus, edge_rows, edge_table, table

from ledgerline.llm import exact_dedup
from ledgerline.llm.rowsets import LOWER, UPPER

AZ = str.maketrans(UPPER, LOWER)


def normal(text):
    return (text or "").translate(AZ)


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[normal(text)].append(doc_id)
    return groups


def test_marks_like_brute_force(spark):
    rows = corpus()
    groups = expected(rows)
    texts = {row[0]: normal(row[1]) for row in rows}
    got = exact_dedup.mark_exact_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = texts[row.doc_id]
        assert row.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (row.keep_id, row.group_size) == (max(groups[text]), len(groups[text]))
        assert row.kept == (row.doc_id == row.keep_id)


def test_a_full_filter_changes_nothing(spark):
    rows = corpus()
    docs = table(spark, rows)
    small = exact_dedup.mark_exact_duplicates(docs, words=1)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, exact_dedup.mark_exact_duplicates(docs).collect()))


def test_only_case_of_a_to_z_is_ignored(spark):
    rows = [(1, "É A", None, None, None), (2, "é a", None, None, None), (3, "É a", None, None, None)]
    got = {row.doc_id: row.keep_id for row in exact_dedup.mark_exact_duplicates(table(spark, rows)).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


def test_edge_cases(spark):
    rows = edge_rows()
    got = exact_dedup.mark_exact_duplicates(edge_table(spark)).collect()
    groups = expected(rows)
    assert len(got) == len(rows)
    assert sum(row.kept for row in got) == len(groups)
    sizes = {hashlib.sha256(text.encode()).hexdigest(): len(ids) for text, ids in groups.items()}
    assert all(row.group_size == sizes[row.text_sha256] for row in got)
    kept = exact_dedup.drop_exact_duplicates(edge_table(spark))
    assert kept.columns == edge_table(spark).columns
    assert sorted(normal(row.text) for row in kept.collect()) == sorted(groups)


def test_the_last_id_stays(spark):
    rows = corpus(seed=9)
    kept = {row.doc_id for row in exact_dedup.drop_exact_duplicates(table(spark, rows)).collect()}
    assert kept == {max(ids) for ids in expected(rows).values()}


def test_empty_table(spark):
    docs = edge_table(spark, [])
    assert exact_dedup.mark_exact_duplicates(docs).collect() == []
    assert exact_dedup.drop_exact_duplicates(docs).collect() == []


def test_rows_alone_with_their_text_are_not_shuffled(spark):
    rows = [(i, f"text {i}", None, None, None) for i in range(500)] + [(1000, "text 7", None, None, None)]
    probed = exact_dedup._probed(table(spark, rows), "doc_id", "text", exact_dedup.FILTER_WORDS)
    assert probed.where("maybe").count() < 20
