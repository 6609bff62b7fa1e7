"""Packing by powers of two: a document's tokens in pieces of binary length.

A piece is a training sequence of its own, so no sequence crosses documents and none needs
padding; sequences of one length form a bucket. Everything happens where the text lies,
without a shuffle.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import documents

MAX_LENGTH = 2048
END_ID = 1
# Distinct words after which a worker starts anew, with those before at hand until the next time;
# forgetting costs time only.
_MEMORY = 200_000
# The pre-tokens of the vocabulary's own splitter; fixed by the file.
_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Taken for white space by str.split but not by the vocabulary.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_BEYOND_LATIN = re.compile("[^\x00-\xff]").search
_UNICODE_SPACE = re.compile(
    "[\t-\r \x85\xa0  -     　]+"
)


class _Learned(dict):
    """Values made when they are first asked for, or taken from those learned before."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]) -> None:
        self._make = make
        self._older = older

    def __missing__(self, key: str) -> bytes:
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value

    def renewed(self) -> _Learned:
        """An empty one that still knows what this one has, but not what came before."""
        self._older = {}
        return _Learned(self._make, self)


def _byte_spelling() -> list[str]:
    """How byte-level vocabularies spell each byte: visible ones as themselves."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(hidden)) for b in range(256)]


class WordTokens:
    """Ids of whole texts, each distinct word going through the tokenizer once.

    The strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._normal = tokenizer.normalizer.normalize_str
        # Pre-tokens go straight to the merges, spelt as the vocabulary spells bytes; those of
        # visible ASCII are spelt as they are.
        self._merge = tokenizer.model.tokenize
        self._spelling = _byte_spelling().__getitem__
        self._split = regex.compile(_PRE_TOKEN).findall
        self._memory = _Learned(self._word_ids, {})
        self._parts = _Learned(self._part_ids, {})

    def _words(self, text: str) -> list[str]:
        if _ODD_SPACE.search(text):
            return [w for w in _UNICODE_SPACE.split(text) if w]
        return text.split()

    def _word_ids(self, word: str) -> bytes:
        # Most words are letters, or letters and a mark.
        if word.isascii():
            low = word.lower()
        elif _BEYOND_LATIN(word):
            return b"".join(map(self._part, self._split(self._normal(word))))
        else:
            # No marks to put together, and no letter with lower-case ones of its own.
            low = word.lower()
        if low.isalpha():
            # A word that is its own part is remembered once.
            return self._part_ids(low) if low == word else self._part(low)
        head, mark = low[:-1], low[-1]
        if head.isalpha() and mark.isascii() and mark.isprintable():
            return self._part(head) + self._parts[mark]
        return b"".join(map(self._part, self._split(low)))

    def _part(self, part: str) -> bytes:
        plain = part.isalpha() and part.islower()
        return self._memory[part] if plain and not _BEYOND_LATIN(part) else self._parts[part]

    def _part_ids(self, part: str) -> bytes:
        if not (part.isascii() and part.isprintable()):
            part = "".join(map(self._spelling, part.encode()))
        return struct.pack(f"<{len(merged := self._merge(part))}I", *[t.id for t in merged])

    def encode_batch(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        for text in texts:
            # Before the text, as a caller that wants one only never comes back after it.
            if len(self._memory) > _MEMORY:
                self._memory = self._memory.renewed()
                self._parts = self._parts.renewed()
            yield b"".join(map(self._memory.__getitem__, self._words(text)))


@functools.cache
def tokens(path: str) -> WordTokens:
    """Read once in each worker."""
    return WordTokens(path)


def pieces(n: int, longest: int = MAX_LENGTH) -> Iterator[tuple[int, int]]:
    """``(start, length)``: as many longest pieces as fit, then the binary digits of the rest."""
    start = 0
    while n - start >= longest:
        yield start, longest
        start += longest
    length = longest
    while start < n:
        length >>= 1
        if n - start >= length:
            yield start, length
            start += length


def power_of_two(
    docs: DataFrame,
    path: str,
    longest: int = MAX_LENGTH,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """``(doc_id, start, ids, length, ids_crc32, doc_tokens, bucket, sequence_id, offset)``.

    One row per piece; ``bucket`` is the binary logarithm of its length. ``sequence_id`` is
    unique and sorts by bucket: bucket, then task, then number within both. A document's ids
    end with ``end_id``, so an empty or NULL text is one piece of one id. Every row is packed,
    repeated ones too; other columns are ignored. ``longest`` must be a power of two. Without
    ``keep_ids`` there is no column ``ids``: for an index of the pieces, or their checksums.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens(path)
        task = TaskContext.get().partitionId()
        numbered = [0] * longest.bit_length()
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(doc_ids, texts, strict=True):
                ids = next(encoder.encode_batch([text])) + end
                n = len(ids) // 4
                for start, length in pieces(n, longest):
                    own = memoryview(ids)[start * 4 : (start + length) * 4]
                    bucket = length.bit_length() - 1
                    sequence = bucket << 56 | task << 32 | numbered[bucket]
                    numbered[bucket] += 1
                    rows.append(
                        (doc_id, start, own, length, zlib.crc32(own), n, bucket, sequence, 0)
                    )
                    size += length
                if size > 1 << 20:
                    yield _piece_batch(rows, keep_ids)
                    rows, size = [], 0
            if rows:
                yield _piece_batch(rows, keep_ids)

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(
        run,
        f"doc_id long, start long,{' ids array<int>,' if keep_ids else ''} length long,"
        " ids_crc32 long, doc_tokens long, bucket int, sequence_id long, offset long",
    )


def _piece_batch(rows: list[tuple], keep_ids: bool) -> pa.RecordBatch:
    doc_id, start, ids, length, crc, n, bucket, sequence, offset = zip(*rows, strict=True)
    columns = {
        "doc_id": pa.array(doc_id, pa.int64()),
        "start": pa.array(start, pa.int64()),
        "ids": None,
        "length": pa.array(length, pa.int64()),
        "ids_crc32": pa.array(crc, pa.int64()),
        "doc_tokens": pa.array(n, pa.int64()),
        "bucket": pa.array(bucket, pa.int32()),
        "sequence_id": pa.array(sequence, pa.int64()),
        "offset": pa.array(offset, pa.int64()),
    }
    if keep_ids:
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), values)
    else:
        del columns["ids"]
    return pa.RecordBatch.from_pydict(columns)


def op10_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = power_of_two(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False
    )
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"
    )
