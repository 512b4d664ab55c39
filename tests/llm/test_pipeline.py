from __future__ import annotations

import os
import random

import pytest
from corpora import corpus, edge_rows, sentence

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm import decontaminate, exact_dedup, near_dedup, pieces, toxicity

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(pieces.TOKENIZERS, "piece_bpe_32k.model")),
                                reason="no vocabulary here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    from ledgerline import session

    root = session.workspace(spark, "corpus")
    rng = random.Random(2)
    rows = corpus(seed=4) + [(1000 + i if i is not None else None, *rest) for i, *rest in edge_rows()]
    item = sentence(rng, 30)
    rows += [(2000, f"{sentence(rng, 30)} {item}", "en", "s", 0)]
    labels = []
    for i in range(200):
        toxic = i % 3 == 0
        rows.append((3000 + i, f"{sentence(rng, 25)}{' idiot scum' * 2 * toxic} {sentence(rng, 20)}", "en", "s", 0))
        labels.append((3000 + i, 1, int(toxic)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_one_after_another(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    numbers = [toxicity, exact_dedup, near_dedup, decontaminate, pieces]
    assert len(corpus_pipeline.STAGES) == len(numbers)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == COLUMNS, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        left = docs.count()
        assert left < before, name
        before = left
        if name == "toxicity":
            assert not docs.where("doc_id >= 3000 and text like '%idiot scum%'").count()
            assert docs.where("doc_id >= 3000").count() == 133
    assert docs.where("doc_id = 2000").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    assert last.where("round_trip").count() == before


def test_run(spark, tables):
    whole = entry.queries()["pipeline"](spark, tables)
    assert whole.columns == ["doc_id", "lang", "source", "n_pieces", "round_trip", "piece_ids"]
    assert whole.where("doc_id >= 3000").count() == 133
    assert whole.where("not round_trip").isEmpty()


def test_every_operator_has_a_query():
    names = entry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
