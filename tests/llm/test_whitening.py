"""Whitening by contour integration against numpy's own eigenvectors."""

import math

import numpy as np
import pytest

from seekloom.llm import whitening
from seekloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, components=4):
    """``{(vec_id, component): (n, deviation, |whitened|, explained)}`` by numpy on all rows at once."""
    full = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: [math.floor(256 * c) for c in v] for i, v in full}
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=np.float64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for i, v in x.items():
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
        for k in range(1, components + 1):
            white = (np.array(v) - sums / n) @ vectors[:, -k] / np.sqrt(values[-k])
            out[i, k] = (n, deviation, abs(white), values[-k] / values.sum())
    return out


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_numpy(spark, size):
    folder = f"/root/testdata/{size}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    truth = expected(rows)
    found = QUERIES["op11_embedding_whitening"](spark, folder).collect()
    assert {(r.vec_id, r.component) for r in found} == set(truth) and len(found) == len(truth)
    for r in found:
        n, deviation, white, explained = truth[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - white) < 1e-8 and abs(r.explained / explained - 1) < 1e-10
        assert 0 <= r.identity_error < 1e-9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    draw = np.random.default_rng(2)
    vectors = [draw.normal(size=3).round(2).tolist() for _ in range(40)]
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    rows += [(100, None, 1), (101, [1.0, None, 0.0], 1), (102, [nan, 0.0, 0.0], 1), (103, [0.0, -inf, 0.0], None), (104, [1.0], 0), (105, [], 0)]
    rows += [(7, vectors[7], 0), (200, vectors[7], 0), (None, vectors[8], None), (201, [-0.0, 0.0, 0.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS x", "2 AS n", "3 AS component", "4 AS at")
    found = whitening.whiten(frame).collect()
    kept = [(i if i is not None else -1, v) for i, v, _ in rows if i not in (100, 101, 102, 103, 104, 105)]
    truth = expected([(i, np.float32(v).astype(float).tolist()) for i, v in kept], 3)
    assert len(found) == 3 * len(kept)
    for r in found:
        n, deviation, white, _ = truth[-1 if r.vec_id is None else r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and abs(abs(r.whitened) - white) < 1e-8
    # Equal vectors have equal coordinates.
    assert len({r.whitened for r in found if r.vec_id in (7, 200) and r.component == 1}) == 1


def test_without_rows_or_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(5)], SCHEMA)).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)


def test_huge_numbers(spark):
    rows = [(i, [1e30 * (i - 2), float(i), float(i * i)], 0) for i in range(5)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id for r in found} == set(range(5)) and all(r.deviation is None for r in found if r.vec_id != 2)


@pytest.mark.parametrize("spectrum", ["spread", "equal", "clustered", "small"])
def test_contour_integration_equals_dense_solver(spectrum):
    draw = np.random.default_rng(5)
    n = 3 if spectrum == "small" else 50
    values = {
        "spread": np.linspace(1, 40, n) ** 2,
        "equal": np.full(n, 7.0),
        "clustered": np.concatenate([[100, 100, 100 - 1e-9, 99.9, 99.8], np.linspace(1, 2, n - 5)]) if n > 5 else None,
        "small": np.array([1.0, 2.0, 3.0]),
    }[spectrum]
    turn, _ = np.linalg.qr(draw.normal(size=(n, n)))
    matrix = turn * values @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.feast(matrix, 4)
    assert np.allclose(found, np.sort(np.linalg.eigvalsh(matrix))[::-1][:4], rtol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12


def test_inertia_counts_eigenvalues():
    draw = np.random.default_rng(6)
    for n in (1, 2, 9, 30):
        matrix = draw.normal(size=(n, n))
        matrix += matrix.T
        values = np.linalg.eigvalsh(matrix)
        for shift in (0.0, -1.0, 2.5, *((values[1:] + values[:-1]) / 2)):
            assert whitening.inertia(matrix, shift) == (values > shift).sum()


def test_groups_merge_to_the_same_covariance():
    rows = np.random.default_rng(7).normal(size=(30, 2)) + 5
    parts = [(len(p), p.mean(axis=0), (p - p.mean(axis=0)).T @ (p - p.mean(axis=0))) for p in (rows[:4], rows[4:5], rows[5:])]
    held = None
    for part in parts:
        held = whitening.merged(held, part)
    assert np.allclose(held[2] / held[0], np.cov(rows.T, bias=True)) and np.allclose(held[1], rows.mean(axis=0))
