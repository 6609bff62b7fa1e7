"""The boundary between small and large sets: any gives the same links, and cost chooses one."""

from __future__ import annotations

import random

import llm_brute as brute
import numpy as np
import pytest

from txmon.llm import jaccard


def near_copies(seed: int, groups: int, most: int) -> dict[int, str]:
    """Texts of 5 to ``most`` words, and copies of them with a word changed."""
    rng = random.Random(seed)
    docs = {}
    for _ in range(groups):
        own = [f"w{rng.randrange(200)}" for _ in range(rng.randint(5, most))]
        for _ in range(rng.randint(1, 5)):
            copy = list(own)
            if rng.random() < 0.7:
                copy[rng.choice([0, -1, rng.randrange(len(own))])] = f"x{rng.randrange(500)}"
            docs[len(docs)] = " ".join(copy)
    return docs


def found(spark, docs):
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    return {r.doc_id: tuple(r)[1:] for r in jaccard.ngram_join(table).collect()}


@pytest.mark.parametrize("boundary", [-1, 12, 22, 99])
def test_every_boundary_gives_all_links(spark, monkeypatch, boundary):
    docs = near_copies(boundary, 120, 120)
    monkeypatch.setattr(jaccard, "_boundary", lambda sets, rank: boundary)
    assert found(spark, docs) == brute.op3(docs)


def test_cost_chooses_a_boundary_inside_the_sizes(spark):
    """Small sets whose elements are common and whose pairs are not, beside large ones."""
    rng = random.Random(4)
    # Sets of 6 out of 40 elements: lists of hundreds, pairs of tens. Large sets: all rare.
    small = [np.array(sorted(rng.sample(range(1, 41), 6)), dtype=np.uint64) for _ in range(4000)]
    large = [np.array([k * 1000 + i for i in range(300)], dtype=np.uint64) for k in range(1, 200)]
    sets = [np.unique(jaccard.mix(s)) for s in (*small, *large)]
    rows = [(i, len(s), s.tobytes()) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "doc_id long, n long, hashes binary")
    counters = jaccard._sketch(table, lambda h: [h], 1, 20)[0]
    assert counters.sum() == sum(len(s) for s in sets)
    rank = np.ceil(np.log2(counters + 1.0)).astype(np.uint8)
    boundary = jaccard._boundary(table, rank)
    assert int(jaccard._size_class(6)) <= boundary < int(jaccard._size_class(300))
