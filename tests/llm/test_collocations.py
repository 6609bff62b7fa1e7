"""Quotient filters keep everything, and phrases are the same however they were merged."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from txmon.llm import collocations
from txmon.llm.collocations import Packing


@given(bits=st.integers(1, 31), seed=st.integers(0, 1000))
def test_permutation_is_invertible(bits, seed):
    rng = np.random.default_rng(seed)
    ids = tuple(rng.integers(0, 1 << bits, 50) for _ in range(3))
    packing = Packing(bits)
    mixed, third = packing.pack(ids)
    assert int(mixed.max()) < 1 << 2 * bits
    for got, want in zip(packing.unpack(mixed, third), ids, strict=True):
        assert got.tolist() == want.tolist()


def test_permutation_hits_every_key_once():
    packing = Packing(3)
    first, second = (x.ravel() for x in np.indices((8, 8)))
    for third in range(8):
        mixed, _ = packing.pack((first, second, np.full(64, third)))
        assert sorted(mixed.tolist()) == list(range(64))


@given(
    bits=st.sampled_from([1, 5, 21, 22, 31]), top=st.integers(0, 2), seed=st.integers(0, 1000), n=st.integers(1, 400)
)
def test_filters_keep_every_key_and_count(bits, top, seed, n):
    rng = np.random.default_rng(seed)
    packing = Packing(bits)
    ids = tuple(rng.integers(0, min(1 << bits, 40), n) for _ in range(3))
    weights = rng.choice([1, 2, 254, 255, 256, 10**12], n)
    keys = packing.added_up(*packing.pack(ids), weights)
    want: dict[tuple, int] = {}
    for gram, w in zip(zip(*(x.tolist() for x in ids), strict=True), weights.tolist(), strict=True):
        want[gram] = want.get(gram, 0) + w
    back = [packing.keys(row, top) for row in packing.filters(keys, top, 7)]
    mixed, third, counts = (np.concatenate(x) for x in zip(*back, strict=True))
    grams = zip(*(x.tolist() for x in packing.unpack(mixed, third)), strict=True)
    assert dict(zip(grams, counts.tolist(), strict=True)) == want
    assert mixed.tolist() == sorted(mixed.tolist())


def test_filters_of_shards_merge():
    packing = Packing(4)
    rng = np.random.default_rng(2)
    rows, total = [], {}
    for shard in range(5):
        ids = tuple(rng.integers(0, 16, 300) for _ in range(3))
        for gram in zip(*(x.tolist() for x in ids), strict=True):
            total[gram] = total.get(gram, 0) + 1
        rows += packing.filters(packing.added_up(*packing.pack(ids)), 1, shard)
    found = {}
    for region in (0, 1):
        own = collocations._table([r for r in rows if r["region"] == region])
        finer = collocations._merge(packing, 1, 3)(own)
        for part in set(finer["region"].to_pylist()):
            got = collocations._frequent(packing, 3, 1)(
                pa.Table.from_pylist([r for r in finer.to_pylist() if r["region"] == part], finer.schema)
            ).to_pydict()
            found |= dict(zip(zip(got["id1"], got["id2"], got["id3"], strict=True), got["a"], strict=True))
    assert found == total


def test_ngrams_stay_in_their_piece():
    first, second, third = collocations._ngrams(np.array([0, 1, 2, 3, 0, 4, 5, 0, 6, 0, 0]))
    grams = sorted(zip(first.tolist(), second.tolist(), third.tolist(), strict=True))
    assert grams == [(1, 2, 0), (1, 2, 3), (2, 3, 0), (4, 5, 0)]


def phrases(spark, folder, **options):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return sorted(map(repr, map(tuple, collocations.collocations(docs, **options).collect())))


def by_sql(folder):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    return sorted(map(repr, database.sql(collocations.OP13_SQL).fetchall()))


@pytest.mark.parametrize("folder", ["odd", "nulls"])
def test_small_blocks_and_rounds_of_merging(spark, request, monkeypatch, folder):
    folder = request.getfixturevalue(folder)
    monkeypatch.setattr(collocations, "_BLOCK_BYTES", 1 << 12)
    monkeypatch.setattr(collocations, "_REGION", 1 << 8)
    monkeypatch.setattr(collocations, "_BLOCK_TOP", 2)
    monkeypatch.setattr(collocations, "_FAN_IN_BITS", 3)
    assert phrases(spark, folder) == by_sql(folder)


def test_cut_and_cover(spark):
    text = ["New York City", "new york city; new york", "york, city", "a b", "b c"] * 10
    rows = [(k, t, None if k % 2 else "und") for k, t in enumerate(text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.phrase: tuple(r) for r in collocations.collocations(docs).collect()}
    # The trigram has two thirds of the bigrams' occurrences, so both are left out.
    assert found.keys() == {"new york city", "a b", "b c"}
    # 20 in all: cut after "new" 20*20/(30*20), after "new york" 20*20/(30*30).
    assert found["new york city"] == ("und", 3, "new york city", 20, 30, 30, 140, 444444)
    assert found["a b"] == ("und", 1, "a b", 10, 10, 20, 140, 500000)
