from __future__ import annotations

import os

import pytest
from corpora import edge_rows, edge_table, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import pieces, token_counts

pytest.importorskip("tiktoken")
PATH = os.path.join(pieces.TOKENIZERS, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.read_ranks(PATH))


PIECES = st.lists(st.sampled_from(["the ", "a", " ", "  ", "\n", "'s", "é", "12", ".", "word and more of it ", "\t"]),
                  max_size=60).map("".join)


@settings(max_examples=200, deadline=None)
@given(PIECES, st.lists(st.tuples(st.integers(0, 400), st.integers(0, 60), PIECES), max_size=4), st.integers(2, 40))
def test_counts_follow_edits(counter, text, changes, leaf):
    usual = token_counts.LEAF
    token_counts.leaves_of.__defaults__ = (leaf,)
    try:
        edits, at = [], 0
        for start, size, new in sorted(changes):
            start = min(max(start, at), len(text))
            at = min(len(text), start + size)
            edits.append((start, at, new))
        tree = counter.tree(text)
        assert tree.total == counter.count(text)
        new, _ = counter.edited(text, tree, edits)
        after = token_counts.apply_edits(text, edits)
        assert new.total == counter.count(after)
        assert sum(new.lengths) == len(after)
        assert tree.total == counter.count(text)
        assert counter.laid_out(after, new)[0].total == counter.count(after)
    finally:
        token_counts.leaves_of.__defaults__ = (usual,)


def test_only_touched_leaves_are_encoded_again(counter):
    import random

    text = sentence(random.Random(3), 20_000)
    tree = counter.tree(text)
    new, encoded = counter.edited(text, tree, [(50_000, 50_003, "three new words")])
    assert new.total == counter.count(text[:50_000] + "three new words" + text[50_003:])
    assert encoded < 5 * token_counts.LEAF


def test_overlapping_edits_are_refused(counter):
    with pytest.raises(ValueError, match="overlap"):
        counter.edited("some text", counter.tree("some text"), [(0, 4, ""), (3, 5, "")])


def test_redactions():
    text = "write to a.b@mail1.example.com, card 4041894974608795 (545) 555-9123 x@y"
    hidden = token_counts.apply_edits(text, token_counts.redactions(text))
    assert hidden == "write to <MAIL>, card <NUMBER> <NUMBER> x@y"


def test_tables(spark, counter):
    docs = token_counts.with_edited_trees(token_counts.with_redactions(token_counts.with_trees(edge_table(spark), PATH)), PATH)
    for row in docs.collect():
        text = row.text or ""
        edits = [(e.start, e.stop, e.replacement) for e in row.edits]
        assert row.tree.sums[1] == counter.count(text)
        assert row.edited.tokens == counter.count(token_counts.apply_edits(text, edits))
    assert docs.count() == len(edge_rows())
    assert token_counts.with_trees(edge_table(spark, []), PATH).collect() == []
