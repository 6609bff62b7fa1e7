"""What tasks of the joins hold and send, in bytes."""

from __future__ import annotations

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from txmon.llm import jaccard, suffix_repeats


@pytest.fixture(autouse=True)
def in_a_task(monkeypatch):
    task = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    for module in (jaccard, suffix_repeats):
        monkeypatch.setattr(module, "TaskContext", task)


def test_anchors_hold_little():
    texts = [random.Random(i).randbytes(200_000) for i in range(8)]
    suffix_repeats._tables.cache_clear()
    tracemalloc.start()
    for _ in suffix_repeats.anchors(texts):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20


def test_equal_contexts_are_sent_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(suffix_repeats, "_PACK", 50_000)
    text = random.Random(1).randbytes(3000)
    many = len(next(suffix_repeats.anchors([text]))[0])
    numbers = np.arange(many, dtype=np.uint32).tobytes()
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(100)), pa.array([text] * 100), pa.array([numbers] * 100)],
        names=["doc_id", "text", "numbers"],
    )
    parts = list(suffix_repeats._pack(4)([batch]))
    held = [sum(len(x.as_py()) for x in p.column("doc_ids")) // 8 for p in parts]
    # Every entry once, and no part with more than its share of them.
    assert sum(held) == 100 * many
    assert max(held) <= 101


def test_shingles_are_sent_in_five_bytes():
    rng = random.Random(2)
    sets = [[f"{rng.random()}" for _ in range(200)] for _ in range(500)]
    sets[7] = sets[3]
    texts = [" ".join(words) for words in sets]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(500)), pa.array(texts)], names=["doc_id", "text"]
    )
    sent = pa.Table.from_batches(jaccard._send(8)([batch]))
    n = sum(len(s) for s in jaccard.shingle_sets([t.encode() for t in texts]))
    assert sum(c.nbytes for c in sent.select([3, 4]).columns) <= 5 * n
    matched = pa.concat_tables(jaccard._match(sent.slice(i, 1)) for i in range(sent.num_rows))
    total = jaccard._total(matched).to_pydict()
    assert [i for i, x in zip(total["doc_id"], total["shared"], strict=True) if x] == [3, 7]


def test_a_group_is_verified_in_little_memory():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(5000)]
    n = len(sets)
    columns = {c: pa.array([k] * n, pa.int64()) for c, k in (("i", 0), ("j", 1), ("copies", 1))}
    columns["side"] = pa.array([k % 2 for k in range(n)], pa.int64())
    columns["doc_id"] = pa.array(range(n), pa.int64())
    columns["hashes"] = pa.array([s.tobytes() for s in sets], pa.binary())
    table = pa.table(columns)
    tracemalloc.start()
    jaccard._verify(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 << 20
