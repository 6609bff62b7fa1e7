"""Mixing: targets and queues against plain Python and the SQL, whatever the layout."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from txmon.llm import common, mixing


def filled(sizes: list[int], weights: list[int], budget: float, passes: int = 2) -> list[float]:
    """Targets by sharing again until no source is above its limit."""
    found: dict[int, float] = {}
    while len(found) < len(sizes):
        left = budget - sum(found.values())
        weight = sum(w for k, w in enumerate(weights) if k not in found)
        share = {k: left * w / weight for k, w in enumerate(weights) if k not in found}
        over = [k for k in share if share[k] >= passes * sizes[k]]
        if not over:
            return [found.get(k, share.get(k)) for k in range(len(sizes))]
        found |= {k: float(passes * sizes[k]) for k in over}
    return [found[k] for k in range(len(sizes))]


@pytest.mark.parametrize(
    "sizes",
    [[100], [10, 1000, 5], [1, 1, 1, 1, 1, 1, 1], [0, 0, 7], [0], [5000, 3, 3, 3, 900, 20, 0, 1]],
)
def test_targets(spark, sizes):
    rows = [(f"s{k}", n) for k, n in enumerate(sizes[:-1])] + [(None, sizes[-1])]
    table = spark.createDataFrame(rows, "source string, source_size long").repartition(3)
    found = mixing.targets(table).orderBy("number").collect()
    weights = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    assert [r.source for r in found] == [s for s, _ in rows]
    assert [r.weight for r in found] == weights
    assert [r.target for r in found] == pytest.approx(filled(sizes, weights, 1.5 * sum(sizes)))


def test_many_sources_in_code_point_order(spark):
    names = ["", "a", "Z", "é", "zz", "￿", "\U00010000", "0"] + [f"n{k}" for k in range(300)]
    table = spark.createDataFrame([(s, 1) for s in names], "source string, source_size long")
    found = mixing.targets(table.repartition(8)).orderBy("number").collect()
    assert [(r.number, r.source) for r in found] == list(enumerate(sorted(names)))


@pytest.mark.parametrize("rows", [mixing._ROWS, 40])
@pytest.mark.parametrize("folder", ["odd", "nulls"])
def test_same_as_sql_with_any_number_of_buckets(spark, request, monkeypatch, rows, folder):
    monkeypatch.setattr(mixing, "_ROWS", rows)
    folder = request.getfixturevalue(folder)
    database = duckdb.connect()
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = database.sql(mixing.OP12_SQL)
    got = mixing.op12_fair_queue(spark, folder).select(*expected.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected.fetchall()))


def test_the_mix_is_a_sequence(spark, odd):
    docs = common.documents(spark, odd).withColumn("source", F.col("doc_id") % 5)
    mix, listed = mixing.fair_queue(docs)
    rows = mix.orderBy("position").collect()
    at, finish = 0, 0.0
    for r in rows:
        assert r.position == at and 0 < r.words <= r.size and r.finish >= finish
        at, finish = at + r.words, r.finish
    taken = dict(mix.groupBy("source").agg(F.sum("words")).collect())
    wanted = {r.source: r.target for r in listed.select("source", "target").distinct().collect()}
    # Every source gets its target to the word, and has its share at any time.
    assert {s: int(t) for s, t in wanted.items() if int(t)} == taken
    longest = max(r.size for r in rows)
    half = [r for r in rows if r.finish <= 0.5]
    for source, target in wanted.items():
        assert abs(sum(r.words for r in half if r.source == source) - target / 2) <= longest


def test_layout_does_not_matter(spark, odd):
    docs = common.documents(spark, odd)
    rows = [
        sorted(map(repr, mixing.mixed(d).collect())) for d in (docs, docs.repartition(9, F.rand(4)))
    ]
    assert rows[0] == rows[1]
    other = mixing.mixed(docs, seed=1)
    assert sorted(map(repr, other.collect())) != rows[0]


def test_equal_rows_are_served_one_by_one(spark):
    docs = spark.createDataFrame([(None, "a b c", "s")] * 50 + [(1, "x", "t")], "doc_id long, text string, source string")
    found = mixing.mixed(docs).collect()
    taken = sorted(r.taken for r in found if r.doc_id is None)
    assert len(taken) == 50 and sum(taken) == int(found[0].target) and max(taken) <= 6
