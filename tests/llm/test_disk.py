"""What the join of near copies leaves on the disks and moves."""

from __future__ import annotations

import random
import time
from pathlib import Path

import corpus_pipeline
import llm_brute as brute
import numpy as np
from pyspark.sql import functions as F

from txmon.llm import common, jaccard
from txmon.session import scratch_dir, short_shuffles


def _table(spark, docs):
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)


def _scratch(spark):
    """The folder that stored tables lie in."""
    return Path(scratch_dir(spark, "none").removeprefix("file:")).parent


def _near_copies(groups, seed=1):
    rng = random.Random(seed)
    docs = {}
    for k in range(groups):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([8, 40, 120]))]
        for c in range(3):
            own = list(words)
            own[rng.randrange(len(own))] = f"x{k}{c}"
            docs[10 * k + c] = " ".join(own + [f"tail{k}"] * c)
    return docs


def test_only_what_the_result_reads_stays_on_the_disks(spark):
    at = _scratch(spark)
    before = set(at.glob("*"))
    docs = _near_copies(20)
    found = {r.doc_id: tuple(r)[1:] for r in jaccard.ngram_join(_table(spark, docs)).collect()}
    assert found == brute.op3(docs)
    left = {p.name.rsplit("-", 1)[0] for p in set(at.glob("*")) - before}
    assert "join-members" in left
    assert left <= {"join-stats", "join-members", "join-ids", "edges"}


def test_the_pipeline_keeps_one_stage(spark, tmp_path, monkeypatch):
    spark.range(6).selectExpr("id AS doc_id", "'a text' AS text").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    at = _scratch(spark)
    before = set(at.glob("stage-*"))
    stages = [(f"{k}", lambda s, docs, d: docs.where("doc_id > 0").selectExpr("doc_id - 1 AS doc_id", "text")) for k in range(4)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert {p.name.rsplit("-", 1)[0] for p in set(at.glob("stage-*")) - before} == {"stage-3"}
    assert sorted(r.doc_id for r in made.collect()) == [0, 1]


def test_near_copies_leave_no_sets(spark):
    docs = _near_copies(15, seed=4)
    table = _table(spark, docs).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    at = _scratch(spark)
    before = set(at.glob("*"))
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, table, "").collect()}
    assert kept == {component for _, component, _ in brute.op3(docs).values()}
    left = {p.name.rsplit("-", 1)[0] for p in set(at.glob("*")) - before}
    assert "join-members" in left
    assert not left & {"join-sets", "join-places", "join-found", "join-groups", "join-sizes"}


def test_a_stored_table_leaves_no_shuffle(spark):
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    count = lambda: sum("shuffle_" in str(f) for f in _files(kept))
    rows = spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    before = count()
    stored = common.store(rows, "rows")
    for _ in range(50):  # they go a moment later
        if count() <= before:
            break
        time.sleep(0.1)
    assert count() <= before
    assert stored.count() == 7
    with short_shuffles(spark):
        pass
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def _files(blocks):
    found = blocks.getAllFiles()
    return [found.apply(i) for i in range(found.size())]


def test_digests_move_rather_than_texts(spark):
    docs = _table(spark, _near_copies(5))
    ids = spark.range(0, 50, 3).selectExpr("id AS rep")
    rows = common.only_ids(
        docs, "doc_id", ids, "rep", lambda x: x.mapInArrow(jaccard._digests, jaccard._DIGESTS)
    )
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.index("Join LeftSemi")
    # The texts are below the join, in what makes the digests.
    assert plan.index("MapInArrow") > joined
    wanted = {r.rep for r in ids.collect()}
    assert {r.doc_id for r in rows.collect()} == {r.doc_id for r in docs.collect()} & wanted


def _sets(spark, sets):
    rows = [(i, len(s), s.tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "mark long, n long, hashes binary")


def test_a_chain_of_sizes_is_no_group(spark):
    """Sets of sizes from 10 to 10,000 that all have one rare element in common."""
    rng = np.random.default_rng(3)
    common_one = jaccard.mix(np.array([7], dtype=np.uint64))
    sizes = [int(10 * 1.2**k) for k in range(38)]
    sets = [
        np.unique(np.append(common_one, rng.integers(0, 1 << 63, n, dtype=np.uint64))) for n in sizes
    ]
    # Every other element is frequent, so this one is in all prefixes.
    rank = np.full(1 << 16, 5, dtype=np.uint8)
    rank[jaccard._slot(common_one, 16)] = 0
    edges = jaccard._meetings(_sets(spark, sets), rank, -1).collect()
    assert edges
    reach = {}
    for e in edges:
        reach.setdefault(e.v, {e.v}).add(e.u)
    widest = max(max(len(sets[x // 2]) for x in g) / min(len(sets[x // 2]) for x in g) for g in reach.values())
    assert widest < 2


def test_linked_sets_meet_in_a_window(spark):
    """Sets at the limit: the smaller inside the larger, with just the overlap that is needed."""
    rng = np.random.default_rng(5)
    for n in [2, 3, 4, 5, 8, 9, 10, 11, 24, 25, 100, 124, 125, 126, 999, 1000, 12_345]:
        for m in {n, n + 1, (n + 100 * n // 80) // 2, 100 * n // 80}:
            if 100 * n < 80 * m:
                continue
            large = np.unique(rng.integers(0, 1 << 63, m, dtype=np.uint64))
            gone = 0
            while 100 * (n - gone - 1) >= 80 * (m + gone + 1):
                gone += 1
            small = np.sort(np.append(rng.choice(large, n - gone, replace=False), rng.integers(0, 1 << 63, gone, dtype=np.uint64)))
            both = np.append(large, small)
            counts = np.bincount(jaccard._slot(both, 16), minlength=1 << 16)
            rank = np.ceil(np.log2(counts + 1.0)).astype(np.uint8)
            for boundary in (-1, int(jaccard._size_class(m)), 99) if m < 200 else (-1,):
                a = jaccard._document_keys(np.sort(large), rank, boundary)
                b = jaccard._document_keys(small, rank, boundary)
                own = len(np.intersect1d(a[0], b[0])) if jaccard._window(n) == jaccard._window(m) else 0
                assert own or len(np.intersect1d(a[0], b[1])) or jaccard._needed(n) < 2, (n, m, boundary)


def test_groups_are_verified_in_rounds_and_blocks(spark, monkeypatch):
    docs = _near_copies(30, seed=2)
    monkeypatch.setattr(jaccard, "_ROUND", 500)
    monkeypatch.setattr(jaccard, "_BLOCK", 150)
    parts = []
    whole = jaccard.store_each
    monkeypatch.setattr(
        jaccard, "store_each", lambda rows, label: whole((parts.append(1) or r for r in rows), label)
    )
    found = {r.doc_id: tuple(r)[1:] for r in jaccard.ngram_join(_table(spark, docs)).collect()}
    assert found == brute.op3(docs)
    assert len(parts) > 1
    assert jaccard._rounds(100, 1) == 1 and jaccard._rounds(3000, 1000) == 12


def test_a_set_is_counted_once_with_its_like(spark):
    """Clusters whose members lie on both sides of a window's edge."""
    rng = random.Random(8)
    docs = {}
    for k in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(30 + 3 * k)]
        for c in range(6):
            docs[100 * k + c] = " ".join([*words, *(f"e{k}{c}{i}" for i in range(c))])
    found = {r.doc_id: tuple(r)[1:] for r in jaccard.ngram_join(_table(spark, docs)).collect()}
    assert found == brute.op3(docs)
