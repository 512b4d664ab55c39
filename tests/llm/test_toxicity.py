from __future__ import annotations

import random

import numpy as np
from corpora import edge_rows, edge_table, sentence, table

from ledgerline.llm import toxicity


def labelled(spark, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.25)
        words = sentence(rng, rng.choice((8, 60))).split(" ")
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(("idiot", "TRASH!!", "loser.", "zorkling", "zorkish", "zorkest")))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = labelled(spark)
    half = spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    chain = toxicity.train(table(spark, rows), half)
    got = {row.doc_id: row.toxicity for row in toxicity.score(table(spark, rows), chain).collect()}
    wrong = [i for i, _, toxic in labels[400:] if (got[i].toxic >= 0.5) != bool(toxic)]
    assert len(wrong) <= 4
    for i, text, *_ in rows[400:]:
        assert (got[i].disgust >= 0.5) <= ("TRASH" in text or "idiot" in text or "loser" in text or "zork" in text)
    kept = toxicity.drop_toxic(table(spark, rows), chain)
    assert {row.doc_id for row in kept.collect()} == {i for i in got if got[i].toxic < 0.5}


def test_later_links_learn_from_out_of_fold_predictions():
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.0, size=(500, 3)).astype(float)
    first = (counts[:, 0] > 1).astype(float)
    links = toxicity.fit_chain(counts, [first, first], np.arange(500) % toxicity.FOLDS)
    assert [len(link) for link in links] == [4, 5]
    assert links[1][4] > 0.5
    chain = toxicity.Chain(["one", "two"], np.zeros(3, dtype=np.uint64), links)
    assert ((chain.scores(counts)[:, 1] >= 0.5) == (first > 0)).mean() > 0.97


def test_edge_cases(spark):
    rows, labels = labelled(spark, 200)
    marks = [*labels, (None, 1, 1), (3, 1, None), (99_999, 0, 1)]
    chain = toxicity.train(table(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    docs = edge_table(spark)
    scored = toxicity.score(docs, chain).collect()
    assert len(scored) == len(edge_rows())
    by_text = {}
    for row in scored:
        assert by_text.setdefault(row.text, row.toxicity) == row.toxicity
    assert by_text[None] == by_text[""]
    kept = toxicity.drop_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert kept.count() == len(scored)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    unlearnt = toxicity.train(table(spark, rows), empty)
    assert {row.toxicity.toxic for row in toxicity.score(docs, unlearnt).collect()} == {0.0}
    assert toxicity.score(edge_table(spark, []), chain).collect() == []
