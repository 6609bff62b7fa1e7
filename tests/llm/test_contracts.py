"""Every query on documents against its contract in plain Python, on an odd small table."""

from __future__ import annotations

import base64
from collections import Counter

import llm_brute as brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txmon.llm import bpe, common, jaccard, packing, pii, quality, registry, sentence_spans, sharding
from txmon.llm import suffix_repeats

SF = "/root/testdata/sf0.001"
ON_DOCUMENTS = [name for name in registry.queries() if not name.startswith("op1_")]


def rows(spark, name, folder, *columns):
    """Results by document."""
    found = registry.queries()[name](spark, folder).select("doc_id", *columns).collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: tuple(r[1:]) for r in found}


@pytest.fixture
def case(odd, odd_docs):
    return odd, odd_docs


def test_personal_spans(spark, case):
    folder, docs = case
    columns = "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    found = rows(spark, "op2_weak_supervision", folder, *columns)
    assert {i: x[:-1] for i, x in found.items()} == brute.op2(docs)
    for i, (*_, spans) in found.items():
        listed = spans.split(",") if spans else []
        assert {f"{k}:{a}:{b}" for k, a, b in brute.base_spans(docs[i])} <= set(listed)
        starts = [int(x.split(":")[1]) for x in listed]
        assert starts == sorted(starts)


def test_near_copies(spark, case):
    folder, docs = case
    found = rows(spark, "op3_heavy_light_join", folder, "n_shingles", "component_id", "n_links")
    assert found == brute.op3(docs)


def test_repeated_bytes(spark, case):
    folder, docs = case
    found = rows(
        spark, "op5_interval_tree", folder, "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    assert found == brute.op5(docs)


def test_shards(spark, case):
    folder, docs = case
    found = rows(spark, "op6_bounded_ring", folder, "size", "text_crc32", "shard", "slot", "law")
    assert found.keys() == docs.keys()
    for i, (size, crc, _, _, law) in found.items():
        assert (size, crc, law) == (len((docs[i] or "").encode()) + 8, brute.crc32(docs[i]), "rows")
    loads = Counter(shard for _, _, shard, _, _ in found.values())
    assert set(loads) <= set(range(24)) and max(loads.values()) - min(
        loads.get(s, 0) for s in range(24)
    ) <= 1
    for s, n in loads.items():
        assert sorted(x[3] for x in found.values() if x[2] == s) == list(range(n))


def test_exact_copies(spark, case):
    folder, docs = case
    found = rows(
        spark, "op8_exact_dedup", folder, "keep_id", "group_size", "kept", "text_sha256"
    )
    assert found == brute.op8(docs)


def test_byte_tokens(spark, case):
    folder, docs = case
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    found = rows(spark, "op9_byte_bpe", folder, "n_tokens", "ids_sha256", "decoded_sha256")
    assert found == brute.op9(docs, own)


def test_packed(spark, case):
    folder, docs = case
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    found = packing.power_of_two(common.documents(spark, folder), path).collect()
    pieces: dict[int, list] = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == docs.keys()
    for i, text in docs.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.offset) == (at, len(ids), 0)
            assert r.length <= 2048 and r.length & (r.length - 1) == 0 and r.bucket == r.length.bit_length() - 1
            data = np.array(r.ids, dtype="<u4").tobytes()
            assert r.ids == ids[at : at + r.length] and r.ids_crc32 == packing.zlib.crc32(data)
            at += r.length
        assert at == len(ids)
    assert len({r.sequence_id for r in found}) == len(found)


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_empty_table(spark, empty, name):
    assert registry.queries()[name](spark, empty).count() == 0


def test_rows_without_ids_and_repeated_rows(spark, nulls):
    docs = common.documents(spark, nulls)
    n = docs.count()
    path = public_tokenizers.path("word_bpe_49k.json")
    assert pii.find_pii(docs).count() == n
    assert quality.line_first(docs).count() == n
    assert sentence_spans.remove_repeated_sentences(docs).count() == n
    assert jaccard.ngram_join(docs).count() == n
    assert suffix_repeats.remove_repeats(docs).count() == n
    placed = sharding.bounded_ring(docs, shards=3).collect()
    assert len({(r.shard, r.slot) for r in placed}) == n == len(placed)
    assert bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == n
    assert packing.power_of_two(docs, path).filter("start = 0").count() == n
    distinct = docs.select("doc_id", "text").distinct().count()
    assert registry.queries()["op8_exact_dedup"](spark, nulls).count() >= distinct


def test_near_copies_of_blank_texts(spark, tmp_path):
    blank = {1: None, 2: "", 3: " \t\n", 4: None}
    some = {5: "a b c d e f g", 6: "A b c d e  f g", 7: "h i j k l m", 8: None}
    for files in ([blank], [blank, some]):
        folder = tmp_path / str(len(files))
        folder.mkdir()
        for k, docs in enumerate(files):
            columns = {"doc_id": pa.array(docs, pa.int64()), "text": pa.array(docs.values(), pa.string())}
            pq.write_table(pa.table(columns), folder / f"{k}.parquet")
        table = spark.read.parquet(str(folder))
        assert table.select(F.spark_partition_id()).distinct().count() == len(files)
        found = {r.doc_id: tuple(r)[1:] for r in jaccard.ngram_join(table).collect()}
        assert found == brute.op3({i: t for docs in files for i, t in docs.items()})


def test_near_copies_of_texts_that_share_an_id_or_have_none(spark):
    a, b, c = ("".join(f"{x}{k} " for k in range(30)) for x in "abc")
    docs = [(2, a), (2, b), (1, a + "end"), (9, b + "end"), (5, b), (None, b), (None, c), (None, c), (7, "x"), (2, "")]
    found = jaccard.ngram_join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = [(2, 26, 1, 1), (2, 26, 1, 3), (1, 27, 1, 1), (9, 27, 1, 3), (5, 26, 1, 3)]
    want += [(None, 26, 1, 3), (None, 26, None, 1), (None, 26, None, 1), (7, 1, 7, 0), (2, 0, 1, 0)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_byte_round_trip(spark, odd, odd_docs):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(common.documents(spark, odd), path, pattern)
    back = {r.doc_id: bytes(r.text).decode() for r in bpe.decode(ids, path, pattern).collect()}
    assert back == {i: t or "" for i, t in odd_docs.items()}


def test_most_rows_stay_on_their_own_shard(spark):
    placed = sharding.bounded_ring(common.documents(spark, SF))
    assert placed.filter("shard = home_shard").count() > 0.7 * placed.count()
