"""Byte-level BPE with a rank queue under a hierarchical bitmap.

Every merge rank has a bucket of linked-list positions. A bitmap says which buckets hold
anything, a second one which words of the first are not empty, so the next rank is two
find-first-set steps away, however long the pre-token. Entries whose pair has changed since
are stale and skipped. ``encode_pieces`` runs one queue over many pre-tokens at once, as
separate lists: a rank is taken for all of them in one step.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import string
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import documents

# White space as Unicode defines it: what \s is in the pattern of the vocabulary.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_NONE = np.int64(1) << 40
_ASCII_SPACE = "\t\n\x0b\x0c\r"
_MARKS = frozenset(string.punctuation)
# Distinct chunks a worker remembers, none of them long; forgetting costs time only.
_MEMORY = 800_000
_LONG = 256
# Chunks of texts that are encoded together.
_GROUP = 1 << 20


class RankQueue:
    """Positions by rank; ``pop`` gives the lowest rank that has any."""

    def __init__(self, ranks: int) -> None:
        self._words = [0] * ((ranks >> 6) + 1)
        self._summary = 0
        self._buckets: dict[int, list[np.ndarray]] = defaultdict(list)

    def push(self, rank: int, positions: np.ndarray) -> None:
        self._buckets[rank].append(positions)
        self._words[rank >> 6] |= 1 << (rank & 63)
        self._summary |= 1 << (rank >> 6)

    def pop(self) -> tuple[int, np.ndarray] | None:
        if not self._summary:
            return None
        word = (self._summary & -self._summary).bit_length() - 1
        bits = self._words[word]
        rank = word << 6 | ((bits & -bits).bit_length() - 1)
        self._words[word] = bits & (bits - 1)
        if not self._words[word]:
            self._summary &= self._summary - 1
        found = self._buckets.pop(rank)
        return rank, np.concatenate(found) if len(found) > 1 else found[0]

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Each position under its own rank."""
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        at = [0, *cuts.tolist(), len(ranks)]
        for rank, lo, hi in zip(ranks[at[:-1]].tolist(), at[:-1], at[1:], strict=True):
            self.push(rank, positions[lo:hi])


class ByteBpe:
    """A vocabulary of byte strings by merge rank, and its split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        spell = [b""] * self.size
        for token, rank in ranks.items():
            spell[rank] = token
        self.spelling = Spelling(spell)
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = self._pairs(spell)
        self._pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self._pair_ranks = np.array([pairs[k] for k in self._pair_keys.tolist()], dtype=np.int64)
        space = pattern.replace("[^\\s", f"[^{_SPACE}").replace("\\S", f"[^{_SPACE}]")
        self.split = regex.compile(space.replace("\\s", f"[{_SPACE}]")).findall
        # A space beside other white space, or first or last: no place to cut.
        self._loose = re.compile(f"[{_SPACE}] | [{_SPACE}]|\\A(?: |\\Z)| \\Z").search
        self._memory: dict[str, bytes] = {}
        # Whether the pattern leaves words and marks as they are, which most do.
        tries = [" ab", "ab", " ab,", "ab,", " ab'", "ab."]
        self._words_stay = [self.split(t) for t in tries] == [
            [" ab"], ["ab"], [" ab", ","], ["ab", ","], [" ab", "'"], ["ab", "."]
        ]

    def _pairs(self, spell: list[bytes]) -> dict[int, int]:
        """Rank of every way to put a token together from two."""
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        return found

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls(
                {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern
            )

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, or _NONE."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        return np.where(self._pair_keys[at] == keys, self._pair_ranks[at], _NONE)

    def encode_pieces(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each pre-token as 32-bit numbers."""
        whole = [self.ranks.get(p) for p in pieces]
        rest = [p for p, rank in zip(pieces, whole, strict=True) if rank is None]
        merged = iter(self._merge(rest)) if rest else iter(())
        return [
            next(merged) if rank is None else rank.to_bytes(4, sys.byteorder) for rank in whole
        ]

    def _merge(self, pieces: Sequence[bytes], careful: bool = False) -> list[bytes]:
        """Merges pair after pair by rank; ``careful`` takes one place of a pre-token a step.

        The places of one rank can be merged together unless a merge makes a pair of lower
        rank, which comes first by the rules; pre-tokens where that happens are done again.
        """
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        n = int(sizes.sum())
        token = self._byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        last = np.cumsum(sizes) - 1
        last = last[sizes > 0]
        # Neighbours; n stands for none.
        after = np.arange(1, n + 1)
        after[last] = n
        before = np.arange(-1, n)
        before[0] = n
        before[last + 1] = n
        token = np.append(token, 0)
        after = np.append(after, n)
        rank = np.full(n + 1, _NONE)
        inner = np.flatnonzero(after[:n] < n)
        rank[inner] = self._rank(token[inner], token[after[inner]])
        alive = np.ones(n + 1, dtype=bool)
        again = np.zeros(len(pieces), dtype=bool)

        queue = RankQueue(self.size)
        ready = np.flatnonzero(rank < _NONE)
        if len(ready):
            queue.push_all(rank[ready], ready)
        while (got := queue.pop()) is not None:
            now, at = got
            at = np.sort(at)
            at = at[alive[at] & (rank[at] == now)]
            if len(at) > 1:
                at = at[np.append(True, at[1:] != at[:-1])]
                if careful:
                    first = np.append(True, owner[at[1:]] != owner[at[:-1]])
                    at, later = at[first], at[~first]
                    if len(later):
                        queue.push(now, later)
                else:
                    # Of places that overlap in a row every other one, from the left.
                    chained = np.append(False, after[at[:-1]] == at[1:])
                    start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                    at = at[(np.arange(len(at)) - start) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            token[at] = now
            alive[gone] = False
            rank[gone] = _NONE
            after[at] = after[gone]
            linked = after[at] < n
            before[after[at][linked]] = at[linked]
            rank[at] = _NONE
            touched = np.concatenate([at[linked], before[at][before[at] < n]])
            if not len(touched):
                continue
            touched = np.unique(touched)
            fresh = self._rank(token[touched], token[after[touched]])
            rank[touched] = fresh
            some = fresh < _NONE
            if not careful and (low := fresh < now).any():
                again[owner[touched[low]]] = True
            if some.any():
                queue.push_all(fresh[some], touched[some])

        kept = np.flatnonzero(alive[:n])
        ids = token[kept].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(owner[kept], minlength=len(pieces)))).tolist()
        out = [ids[lo:hi] for lo, hi in zip([0, *ends], ends)]  # noqa: B905
        if again.any():
            redo = np.flatnonzero(again).tolist()
            for i, x in zip(redo, self._merge([pieces[i] for i in redo], True), strict=True):
                out[i] = x
        return out

    def _learn(self, chunks: Iterable[str]) -> None:
        """Encodes chunks the memory lacks, their pre-tokens all in one queue."""
        chunks = list(chunks)
        if not chunks:
            return
        split = [self._pre_tokens(c) for c in chunks]
        pieces = list(dict.fromkeys(p for parts in split for p in parts))
        known = dict(
            zip(pieces, self.encode_pieces([p.encode() for p in pieces]), strict=True)
        )
        for chunk, parts in zip(chunks, split, strict=True):
            self._memory[chunk] = (
                known[parts[0]] if len(parts) == 1 else b"".join(map(known.__getitem__, parts))
            )

    def _pre_tokens(self, chunk: str) -> list[str]:
        """The chunk split by the pattern; most are a word, or a word and a mark after it."""
        if self._words_stay and chunk.isascii():
            word = chunk[1:] if chunk[:1] == " " else chunk
            if word.isalpha():
                return [chunk]
            if word[:-1].isalpha() and word[-1] in _MARKS:
                return [chunk[:-1], word[-1]]
        return self.split(chunk)

    def _is_loose(self, text: str) -> bool:
        """Whether a space is beside other white space, first or last."""
        if not text.isascii():
            return self._loose(text) is not None
        return (
            text[:1] == " "
            or text[-1:] == " "
            or "  " in text
            or any(c in text and (c + " " in text or " " + c in text) for c in _ASCII_SPACE)
        )

    def _chunks(self, text: str) -> list[str]:
        """The text in chunks that can be encoded one by one.

        A space and the word after it belong together, so a text can be cut before single
        spaces; else its chunks are its pre-tokens.
        """
        if self._is_loose(text):
            return self.split(text)
        head, *words = text.split(" ")
        return [head, *[" " + w for w in words]]

    def encode_batch(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """Ids of each text; texts are looked at some at a time, long ones alone."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            chunks = self._chunks(text)
            group.append(chunks)
            size += len(chunks)
            if size >= _GROUP:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[list[str]]) -> Iterator[np.ndarray]:
        missing = set().union(*group).difference(self._memory)
        if len(self._memory) + len(missing) > _MEMORY:
            self._memory.clear()
            missing = set().union(*group)
        self._learn(missing)
        for chunks in group:
            found = b"".join(map(self._memory.__getitem__, chunks))
            yield np.frombuffer(found, dtype=np.int32)
        for chunk in missing:
            if len(chunk) > _LONG:
                del self._memory[chunk]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.spelling(ids)


class Spelling:
    """Byte strings by id, put together for many ids at once."""

    def __init__(self, strings: Sequence[bytes]) -> None:
        self._sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._octets = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        at = np.repeat(self._starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])
        return self._octets[at].tobytes()


@functools.cache
def vocabulary(path: str, pattern: str) -> ByteBpe:
    """Read once in each worker."""
    return ByteBpe.load(path, pattern)


@functools.cache
def _decimals(size: int) -> Spelling:
    return Spelling([b"%d " % i for i in range(size)])


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, ids array<int>)`` for every row; a NULL text gives no ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [x.tolist() for x in bpe.encode_batch(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, text binary)``: the bytes that the ids spell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for batch in batches:
            texts = [
                None if ids is None else bpe.decode(np.array(ids, dtype=np.int64))
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes and decodes every whole text where it lies; returns counts and digests only.

    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, a row for every row; a NULL text is
    empty, an empty one has no tokens. Other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        decimal = _decimals(bpe.size)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = [
                (len(ids), sha(decimal(ids)[:-1]), sha(bpe.decode(ids)))
                for ids in bpe.encode_batch(texts)
            ]
            n, spelled, decoded = map(list, zip(*rows, strict=True)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(spelled, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
