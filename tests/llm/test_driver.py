"""What the driver plans and gathers for steps that run many queries."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from txmon.llm import common, pii
from txmon.llm import components as tree


def _captured(monkeypatch, spark) -> list:
    """The tables that are collected from now on."""
    frame, seen = type(spark.range(1)), []
    for name in ("collect", "first"):
        whole = getattr(frame, name)
        monkeypatch.setattr(frame, name, lambda self, whole=whole: seen.append(self) or whole(self))
    return seen


def test_rounds_of_training_have_small_plans(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(7)), *rng.integers(-1, 2, 6).tolist(), int(n)) for n in rng.integers(1, 10**6, 400)]
    table = spark.createDataFrame(rows, ["kind", *pii.LABELERS, "n"])
    counts = table.groupBy("kind", *pii.LABELERS).agg(F.sum("n").alias("n"))
    want = sorted(tuple(r) for r in counts.collect())
    seen = _captured(monkeypatch, spark)
    model = pii.train(counts, rounds=3, steps=2)
    # A column for each sum made a round's plan wide: 38 and 119 sums.
    assert len(seen) >= 5 and max(len(df.columns) for df in seen) <= 4
    # Plain numpy.
    kind, said, n = (np.array([r[a:b] for r in want]) for a, b in ((0, 1), (1, 7), (7, 8)))
    n, total = n[:, 0], said.sum(axis=1)
    y = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    for _ in range(3):
        both = np.stack([n * (1 - y), n * y])
        mass = both.sum(axis=1)
        prior = (mass[1] + 1) / (mass.sum() + 2)
        cells = 1 + np.array([[[b[said[:, j] == v].sum() for v in (-1, 0, 1)] for b in both] for j in range(6)])
        share = cells / cells.sum(axis=2, keepdims=True)
        gain = np.log(share[:, 1] / share[:, 0])
        odds = np.log(prior / (1 - prior)) + sum(gain[j, said[:, j] + 1] for j in range(6))
        y = 1 / (1 + np.exp(-odds))
    x = np.hstack([np.ones((len(n), 1)), said, kind == np.arange(7)])
    w = np.zeros(14)
    for _ in range(2):
        p = 1 / (1 + np.exp(-x @ w))
        curve = np.eye(14) + (x * (n * p * (1 - p))[:, None]).T @ x
        w = w + np.clip(np.linalg.solve(curve, x.T @ (n * (y - p)) - w), -4, 4)
    assert abs(model.prior - prior) < 1e-6 and np.allclose(model.reliability, share, atol=1e-6)
    assert np.allclose(model.weights, w, atol=1e-6)


def test_rounds_of_components_have_small_plans(spark, monkeypatch):
    rng = np.random.default_rng(6)
    pairs = rng.integers(0, 400, (300, 2)).tolist() + [(1000 + i, 1001 + i) for i in range(40)]
    pairs += [(7, 7), (None, 3), (2000, 3000), (3000, 2000), (2000, 3000)]
    plans, whole = [], tree.store
    monkeypatch.setattr(
        tree,
        "store",
        lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or whole(df, label),
    )
    found = tree.components(spark.createDataFrame(pairs, "u long, v long")).collect()
    label = {i: i for p in pairs if None not in p and p[0] != p[1] for i in p}
    for _ in label:
        for a, b in pairs:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert sorted((r.node, r.root) for r in found) == sorted(label.items())
    # Edges are read at most four times in a round's plan; a union in each step made it sixteen.
    assert len(plans) >= 2 and max(len(re.findall("Relation", p)) for p in plans[1:]) <= 4


def test_a_stored_table_is_read_without_a_job(spark):
    table = spark.range(9).selectExpr("id", "array(named_struct('a', cast(id as string))) AS x", "unhex('ff') AS b")
    context = spark.sparkContext
    context.setJobGroup("stored-table", "")
    try:
        read = common.store(table, "known")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("stored-table")) == 1
    assert read.dtypes == table.dtypes and sorted(read.collect()) == sorted(table.collect())
    assert common.store(table.limit(0), "none").dtypes == table.dtypes
