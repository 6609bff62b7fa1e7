"""How many Python workers a task has, and what they hold."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from txmon.llm import common, jaccard, packing, suffix_repeats


def test_the_id_filter_needs_no_python_worker(spark):
    ids = spark.range(0, 3000, 7).selectExpr("id * 13 - 500 AS key", "id").unionByName(
        spark.sql("SELECT CAST(NULL AS bigint) AS key, 0L AS id")
    )
    docs = spark.range(-600, 50_000).selectExpr("id AS doc_id").unionByName(
        spark.sql("SELECT CAST(NULL AS bigint) AS doc_id")
    )
    test = common.may_be_in(ids, "key")
    rows = docs.select("doc_id", test(F.col("doc_id")).alias("may"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    found = {r.doc_id: r.may for r in rows.collect()}
    wanted = {r.key for r in ids.collect()} & set(found)
    assert None in wanted and all(found[i] for i in wanted)
    # Hardly any others pass.
    assert sum(found.values()) <= len(wanted) + 20


def test_a_task_of_the_join_has_one_python_worker(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "CAST(id % 9 AS string) AS text")
    ids = spark.range(0, 100, 3).selectExpr("id AS rep")
    for work, form in ((jaccard._digests, jaccard._DIGESTS), (jaccard._set_rows, jaccard._SETS)):
        rows = common.only_ids(docs, "doc_id", ids, "rep").mapInArrow(work, form)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
        assert sorted(r.doc_id for r in rows.collect()) == list(range(0, 100, 3))


def test_a_task_of_the_repeats_has_one_python_worker(spark):
    passage = "'" + " ".join(f"word{i}" for i in range(40)) + "'"
    docs = spark.range(20).selectExpr("id AS doc_id", f"concat('own', id, {passage}) AS text")
    kept = docs.filter(~common.may_be_in(spark.range(3), "id")(F.col("doc_id")))
    spans = suffix_repeats.repeated_spans(kept)
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    assert {r.doc_id for r in spans.collect()} == set(range(4, 20))


def test_anchors_are_spread_over_the_buckets():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 20_000, dtype=np.uint8).tobytes() for _ in range(20)]
    hashes = np.concatenate([own[0] for own in suffix_repeats.anchors(texts)])
    # Least hashes of 69 lie near 0: by their upper bits, the first of 16 buckets had nearly all.
    sizes = np.bincount((hashes >> np.uint64(60)).astype(np.int64), minlength=16)
    assert len(hashes) > 9000 and sizes.max() < 1.2 * len(hashes) / 16


def test_ids_of_blocks_are_spread_over_the_buckets(spark):
    docs = spark.range(0, 64, 1, 8).selectExpr("id AS doc_id", "repeat(concat('own text ', id), 20) AS text")
    sent = docs.mapInArrow(suffix_repeats._send(16), suffix_repeats._SENT)
    rows = sent.filter("ids IS NOT NULL").select("bucket", "batch").collect()
    assert len({r.batch for r in rows}) == 8 and len({r.bucket for r in rows}) == 8


def test_contexts_of_a_frequent_gram_are_compared_in_parts(monkeypatch):
    rng = np.random.default_rng(4)
    prose = lambda n: rng.integers(97, 101, n, dtype=np.uint8).tobytes()
    line, passage = prose(85), prose(180)
    docs = [(i, prose(150) + (line, passage)[i % 2] + prose(150)) for i in range(60)]
    docs += [(100 + i, prose(10 * i) + b"The " * (30 + i)) for i in range(10)]
    docs += [docs[1]] * 8 + [docs[0], docs[64]]
    rows = []
    for (doc_id, text), (_, place, first, many) in zip(
        docs, suffix_repeats.anchors([t for _, t in docs]), strict=True
    ):
        for p, f, m in zip(place.tolist(), first.tolist(), many.tolist(), strict=True):
            rows.append((doc_id, f, p - f, m + 99, text[f : f + m + 99]))
    *numbers, texts = zip(*rows, strict=True)
    numbers = [np.array(x, dtype=np.int64) for x in numbers]
    # All strings of 100 bytes, the plain way.
    earliest: dict[bytes, tuple[int, int]] = {}
    for doc_id, text in docs:
        for at in range(len(text) - 99):
            place = (doc_id, at)
            earliest[text[at : at + 100]] = min(place, earliest.get(text[at : at + 100], place))
    wanted = {
        (doc_id, at + k)
        for doc_id, text in docs
        for at in range(len(text) - 99)
        if earliest[text[at : at + 100]] < (doc_id, at)
        for k in range(100)
    }
    whole, compared = suffix_repeats.maximal_repeats, []
    monkeypatch.setattr(
        suffix_repeats,
        "maximal_repeats",
        lambda rights, lefts: compared.append(len(rights)) or whole(rights, lefts),
    )
    for most in (1, 2, 7, 50, 10_000):
        compared.clear()
        found = suffix_repeats.covered(*numbers, b"".join(texts), most)
        spans = zip(*(x.tolist() for x in found), strict=True)
        assert {(i, k) for i, begin, end in spans for k in range(begin, end)} == wanted
        assert max(compared, default=0) <= most
    assert len(wanted) > 5000


def test_frequent_words_are_learned_once():
    own = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    merge, merged = own._merge, []
    own._merge = lambda part: merged.append(part) or merge(part)
    n = packing._MEMORY // 40
    for i in range(0, 150 * n, n):
        next(own.encode_batch([" ".join(["often", "Oft,", "déjà", *map(letters, range(i, i + n))])]))
    assert [merged.count(part) for part in ("often", "oft", ",", "dÃ©jÃł")] == [1] * 4
    assert len(own._memory) + len(own._memory._older) <= 2 * packing._MEMORY + 4 * n


def letters(i: int) -> str:
    return "x" + str(i).translate(str.maketrans("0123456789", "abcdefghij"))
