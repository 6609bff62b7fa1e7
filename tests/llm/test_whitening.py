"""Whitening against exact arithmetic and numpy's own eigenvectors."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from txmon.llm import registry, whitening

CLUSTERED = {
    "spread": list(np.linspace(1, 2, 40)),
    "close": [1 + 1e-9 * k for k in range(8)] + list(np.linspace(2, 3, 20)),
    "closer": [1 + 1e-12 * k for k in range(8)] + list(np.linspace(2, 3, 20)),
    "two clusters": [1.0, 1 + 2e-8, 1 + 1e-7, 3.0, 3 + 1e-10, 3 + 2e-10, 10.0],
    "equal": [1.0] * 8 + list(np.linspace(2, 3, 20)),
    "without variance": [0.0] * 20 + list(np.linspace(2, 3, 10)),
    "graded": [1e-9, 1e-6, 1.0, 1e6],
    "one": [5.0],
}


def matrix(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values), len(values))))[0]
    q = whitening._orthonormal(q.astype(np.longdouble))
    a = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values", CLUSTERED.values(), ids=CLUSTERED.keys())
def test_refined_beyond_double(values):
    a, _ = matrix(values)
    found, x = whitening.refined_eigenvectors(a)
    size = max(values)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-18 * size * 8
    assert np.abs(a @ x - x * found).max() < 1e-17 * size
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17


def test_close_vectors_are_told_apart():
    """64 bits see nothing in a gap of 1e-12 of the largest; the sub-solve does."""
    values = CLUSTERED["closer"]
    a, q = matrix(values)
    _, x = whitening.refined_eigenvectors(a)
    want = q[:, np.argsort(values)[::-1]]
    off = 1 - np.abs((want * x).sum(axis=0))
    plain = np.linalg.eigh(a.astype(float))[1][:, ::-1]
    assert off.max() < 1e-9 < (1 - np.abs((want * plain).sum(axis=0))).max()


def expected(table):
    kept = [
        (i, v)
        for i, v in zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist(), strict=True)
        if v is not None and len(v) == 9
        and all(c is not None and np.isfinite(c) and abs(c) < 1e9 for c in v)
    ]
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    off = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    cov = np.array(
        [[float(Fraction(sum(r[i] * r[j] for r in off), n**3)) for j in range(9)] for i in range(9)]
    )
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = np.array([[float(Fraction(c, n)) for c in row] for row in off]) @ vectors / np.sqrt(values)
    return [i for i, _ in kept], [sum(c * c for c in row) for row in off], white, values / values.sum()


def test_whitened(spark, odd):
    from conftest import vectors

    ids, deviations, white, explained = expected(vectors())
    found = registry.queries()["op11_mixed_precision"](spark, odd).collect()
    assert len(found) == 8 * len(ids)
    assert {r.n for r in found} == {len(ids)}
    assert max(r.identity_error for r in found) < 1e-12
    # Rows by their id and deviation; equal rows have equal results.
    signs = {}
    want = {(i, d, k + 1): w for i, d, row in zip(ids, deviations, white, strict=True) for k, w in enumerate(row)}
    for r in found:
        value = want[r.vec_id, r.deviation, r.component]
        if r.component not in signs and abs(value) > 0.1:
            signs[r.component] = np.sign(value * r.whitened)
    assert len(signs) == 8
    for r in found:
        value = want[r.vec_id, r.deviation, r.component] * signs[r.component]
        assert abs(r.whitened - value) < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    assert sorted(map(repr, ((r.vec_id, r.deviation) for r in found if r.component == 3))) == sorted(
        map(repr, zip(ids, deviations, strict=True))
    )


def test_partitions_do_not_matter(spark, odd):
    table = spark.read.parquet(f"{odd}/embeddings.parquet")
    rows = [
        sorted(map(repr, whitening.whiten(t, 3).drop("identity_error").collect()))
        for t in (table, table.repartition(7, F.rand(2)))
    ]
    assert rows[0] == rows[1]


def test_tables_without_variance(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([(1, [0.5, 0.25])], [(k, [0.5, 0.25]) for k in range(4)], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, kind)).count() == 0
    # One direction only: one component.
    line = spark.createDataFrame([(k, [k / 8, k / 4]) for k in range(5)], kind)
    assert [(r.component, r.explained) for r in whitening.whiten(line).filter("vec_id = 0").collect()] == [(1, 1.0)]


def test_large_entries_are_exact(spark):
    values = [[3e12, 1.0], [-2e12, 2.0], [1e12 + 0.5, -3.0], [0.0, 5.5]]
    table = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "vec_id long, embedding array<double>")
    model = whitening.fit(whitening.on_grid(table))
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in values]
    assert model.sums == tuple(sum(c) for c in zip(*x, strict=True))
    got = {r.vec_id: int(r.deviation) for r in whitening.transform(whitening.on_grid(table), model).collect()}
    assert got == {
        k: sum((4 * c - s) ** 2 for c, s in zip(row, model.sums, strict=True)) for k, row in enumerate(x)
    }
