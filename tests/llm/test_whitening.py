from __future__ import annotations

import math
import random

import numpy as np
import pytest
from corpora import CLASHES
from pyspark.sql import functions as F

from ledgerline.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(vectors):
    """Deviations and covariance by whole numbers and fractions, without Spark."""
    grid = [[math.floor(64 * c) + 1_000_000 for c in vector] for vector in vectors]
    n = len(grid)
    sums = [sum(column) for column in zip(*grid, strict=True)]
    deviations = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in grid]
    centred = np.array([[(n * x - s) / n for x, s in zip(row, sums, strict=True)] for row in grid])
    return deviations, centred, centred.T @ centred / n


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, row, 0) for i, row in rows], schema)


def random_rows(n=300, dimension=12, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dimension)) @ rng.normal(size=(dimension, dimension)) + rng.normal(size=dimension)
    return [(i, row.tolist()) for i, row in enumerate(mixed)]


def test_against_plain_numbers(spark):
    rows = random_rows()
    deviations, centred, covariance = plain([row for _, row in rows])
    found = whitening.components_of(table(spark, rows), components=5).collect()
    assert len(found) == 300 * 5
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:5], axes[:, ::-1][:, :5]
    expected = centred @ axes / np.sqrt(values)
    own = np.zeros_like(expected)
    for row in found:
        assert (row["n"], row["deviation"]) == (300, deviations[row["vec_id"]])
        assert row["explained"] == pytest.approx(values[row["component"] - 1] / np.trace(covariance), rel=1e-12)
        own[row["vec_id"], row["component"] - 1] = row["whitened"]
    assert np.abs(np.abs(own) - np.abs(expected)).max() < 1e-9
    assert np.abs(own.T @ own / 300 - np.eye(5)).max() < 1e-12
    assert len({row["identity_error"] for row in found}) == 1
    assert found[0]["identity_error"] < 1e-12


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [1, 1, 1, 1, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5], [1e6, 1, 1 + 1e-8, 1e-6, 1e-6 * (1 + 1e-6)],
    [1, 1e-3, 1e-9, 1e-9 * (1 + 1e-5), 1e-12], [3, 0, 0, 0, 0], [0, 0, 0, 0, 0]])
def test_clusters_are_refined(values):
    rng = np.random.default_rng(3)
    turn, _ = np.linalg.qr(rng.normal(size=(5, 5)))
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, axes = whitening.eigenvectors(matrix)
    assert np.abs(axes.T @ axes - np.eye(5)).max() < 1e-14
    scale = max(np.abs(matrix).max(), 1e-300)
    # residuals at the level of double precision, far below what single precision leaves
    assert np.abs(matrix @ axes - axes * found).max() <= 4e-15 * scale
    assert np.allclose(found, sorted(np.linalg.eigvalsh(matrix))[::-1], rtol=0, atol=1e-14 * scale)


def test_refinement_squares_the_error():
    rng = np.random.default_rng(5)
    turn, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    matrix = turn @ np.diag(np.linspace(1, 3, 40)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    _, start = np.linalg.eigh(matrix.astype(np.float32))

    def error(x):
        x = x.astype(np.float64)
        return np.abs(x.T @ matrix @ x - np.diag(np.diag(x.T @ matrix @ x))).max()

    assert error(start) > 1e-8
    assert error(whitening.refined(matrix, start, rounds=1)) < 1e-11
    assert error(whitening.refined(matrix, start)) < 1e-14


def test_what_is_left_out(spark):
    rows = random_rows(60, 4)
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0])]
    kept = rows + [(None, rows[0][1]), rows[1], rows[1]]
    found = whitening.components_of(table(spark, kept + odd).withColumns({name: F.lit("extra") for name in CLASHES}))
    assert {row["vec_id"] for row in found.collect()} == {i for i, _ in kept}
    assert found.count() == len(kept) * 4
    assert {row["n"] for row in found.select("n").collect()} == {len(kept)}


def test_tables_without_components(spark):
    same = [(i, [0.5, 0.25]) for i in range(4)]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], same):
        found = whitening.components_of(table(spark, rows))
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert found.count() == 0


def test_a_dimension_without_variance(spark):
    rows = [(i, [*row, 7.0]) for i, row in random_rows(50, 3)]
    found = whitening.components_of(table(spark, rows))
    assert found.count() == 50 * 3
    assert found.first()["identity_error"] < 1e-9


def test_wide_entries_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1e9, 1e9), rng.uniform(-1, 1)]) for i in range(9)]
    rows += [(9, [3e15, 0.0])]
    deviations, *_ = plain([row for _, row in rows])
    found = {row["vec_id"]: row["deviation"] for row in whitening.components_of(table(spark, rows)).collect()}
    assert found == {i: value if value < 1 << 63 else None for (i, _), value in zip(rows, deviations, strict=True)}


def test_floats(spark):
    rows = random_rows(40, 3)
    one = whitening.components_of(table(spark, rows, "vec_id long, embedding array<float>, label int"), components=2)
    assert one.count() == 80
