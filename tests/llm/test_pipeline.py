"""The corpus pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import llm_brute as brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from txmon.llm import common, pii, quality


def test_stages(spark, odd):
    folder = odd
    docs = common.documents(spark, folder)
    want = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = common.store(stage(spark, before, folder), "stage")
        assert docs.columns == corpus_pipeline.COLUMNS
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality rules":
            judged = {i: brute.clean_lines(t, quality.BOILERPLATE) for i, t in want.items()}
            want = {i: t for i, (t, kept) in judged.items() if kept}
        elif name == "exact dedup":
            want = {i: want[i] for i, (_, _, kept, _) in brute.op8(want).items() if kept}
        elif name == "n-gram Jaccard join":
            want = {i: want[i] for i, (_, low, _) in brute.op3(want).items() if low == i}
        else:
            spans = {r.doc_id: r.found for r in pii.find_pii(before).collect()}
            want = {i: _masked(t, spans[i]) for i, t in want.items()}
        assert got == want, name
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    pieces: dict[int, list] = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == want.keys()
    for i, text in want.items():
        ids = np.concatenate([r.ids for r in sorted(pieces[i], key=lambda r: r.start)])
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_copies_go_by_row(spark, nulls):
    docs = common.documents(spark, nulls)
    texts = [r.text or "" for r in docs.collect()]
    exact = common.store(corpus_pipeline.exact_copies(spark, docs, nulls), "stage")
    kept = [(r.doc_id, r.text or "") for r in exact.collect()]
    # Every text once, with the largest of its ids.
    assert sorted(t.lower() for _, t in kept) == sorted({t.lower() for t in texts})
    for doc_id, text in kept:
        own = [r.doc_id for r in docs.collect() if (r.text or "").lower() == text.lower()]
        assert doc_id == max((i for i in own if i is not None), default=None)
    # Linked rows without ids go, too; texts that share an id are judged by themselves.
    a, b = ("".join(f"{x}{k} " for k in range(30)) for x in "ab")
    rows = [(2, a), (2, b), (5, a + "end"), (None, b + "end"), (None, "x y"), (2, a)]
    table = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    near = corpus_pipeline.near_copies(spark, table, nulls).collect()
    assert sorted((r.doc_id or 0, r.text) for r in near) == [(0, "x y"), (2, a), (2, b)]


def _masked(text, spans):
    out, at = "", 0
    for x in spans:
        if x.start >= at:
            out += text[at : x.start] + f"[{pii.KINDS[x.kind].upper()}]"
        at = max(at, x.end)
    return out + text[at:]


def test_run(spark, odd, empty):
    assert corpus_pipeline.run(spark, odd).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0
