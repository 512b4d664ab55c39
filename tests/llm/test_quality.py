from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpora import edge_rows, edge_table, sentence, table

from ledgerline.llm import quality
from ledgerline.llm.wordhash import Splitter


def labelled(n=900):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = int(rng.random() < 0.8)
        text = sentence(rng, rng.choice((5, 40, 300))) + "."
        if not good:
            text = rng.choice((text.upper() + "!!", text.replace(" ", " | "), "spam " * 40, text.replace(" ", "### ")))
        rows.append((i, text, "en", "s", 0))
        labels.append((i, good, 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    model = quality.train(quality.described(table(spark, rows)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scored = quality.score(quality.described(table(spark, rows)), model).withColumn("out", quality.held_out(quality.F.col("doc_id")))
    got = {row.doc_id: row for row in scored.collect()}
    assert all(row.out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, row in got.items())
    right = [(got[i].quality_score >= 0.5) == bool(good) for i, good, _ in labels if got[i].out]
    assert np.mean(right) > 0.95


def test_held_out_labels_are_not_read(spark):
    rows, labels = labelled(300)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 0) for i, q, _ in labels]
    models = [quality.train(quality.described(table(spark, rows)), spark.createDataFrame(one, "doc_id long, quality int, toxic int"))
              for one in (labels, turned)]
    assert np.allclose(models[0].means, models[1].means)
    assert np.allclose(models[0].factors, models[1].factors)


def test_log_density_by_the_inverse(spark):
    rng = np.random.default_rng(2)
    classes = [rng.normal(size=(200, 3)) * 2, rng.normal(size=(300, 3)) + 1]
    model = quality.discriminant([200.0, 300.0], [one.sum(axis=0) for one in classes], [one.T @ one for one in classes])
    x = rng.normal(size=(20, 3))
    logs = []
    for mean, factor, share in zip(model.means, model.factors, (0.4, 0.6), strict=True):
        cov = factor @ factor.T
        d = x - mean
        logs.append(np.log(share) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))


def test_statistics_of_a_text():
    rows = quality.statistics(Splitter(), pa.array(["The the cat | 12\nsat", None, "", "x"]))
    names = dict(zip(quality.STATISTICS, rows[0], strict=True))
    assert names["log_words"] == pytest.approx(np.log1p(6))
    assert names["bars"] == pytest.approx(np.log(1.5 / 19.5))
    assert names["repeated_next"] == pytest.approx(np.log(1.5 / 5.5))
    assert names["top_word"] == pytest.approx(np.log(2.5 / 4.5))
    assert (rows[1] == rows[2]).all()
    assert np.isfinite(rows).all()


def test_edge_cases(spark):
    rows, labels = labelled(200)
    marks = [*labels, (None, 1, 0), (4, None, 0), (5, 7, 0)]
    model = quality.train(quality.described(table(spark, rows)), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    scored = quality.score(quality.described(edge_table(spark)), model).collect()
    assert len(scored) == len(edge_rows())
    assert all(0 <= row.quality_score <= 1 for row in scored)
    by_text = {}
    for row in scored:
        assert by_text.setdefault(row.text or "", row.quality_score) == row.quality_score
    none = quality.train(quality.described(table(spark, rows)), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {row.quality_score for row in quality.score(quality.described(edge_table(spark)), none).collect()} == {0.5}
    assert quality.score(quality.described(edge_table(spark, [])), model).collect() == []
