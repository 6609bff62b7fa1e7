"""Size-aware heavy-light join of documents by the Jaccard similarity of word shingles.

1. A shingle that no other document has can't be shared. Tasks send their shingles' hashes
   to hash ranges in sorted blocks; what comes back is how many of a document's shingles
   occur elsewhere. A link needs that share to reach the threshold, so most documents are done.
2. Equal sets become one representative.
3. Shingles have a global order, rare ones first (a sketch sized by their number counts them).
   Linked sets share an element in their prefixes, and two in prefixes longer by one. Small
   sets enumerate all 2-subsets of the longer prefix; large ones, and what is nearly large, are
   listed under every prefix element. The boundary is the size with the least total cost: for
   both kinds of keys, the bytes of the keys and of the entries of the lists they make.
   Sets meet in windows of size: in its own a set meets its like and smaller ones, in the next
   the larger ones. Sets that meet under a key of a window are grouped, so a chain of chance
   meetings can't tie sets of all sizes together.
4. Inside a group inverted lists are scanned for exact overlaps, large groups in blocks. Where
   sets would lie on the disks several times for it, groups are verified in rounds.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import (
    discard,
    documents,
    may_be_in,
    only_ids,
    partitions,
    small_batches,
    store,
    store_each,
)
from txmon.llm.components import _forest, components
from txmon.operators.joins import attach
from txmon.session import short_shuffles

SHINGLE = 5
# Similarity at least this many percent.
PERCENT = 80
# Text hashed at once, and shingles that a task sorts at once.
_TEXT_CHUNK = 1 << 19
_SORT_CHUNK = 1 << 18
_MANY = 0xFFFF
# Bits of a sketch's slots, least and most; in between as the number of shingles has. The driver
# holds two such sketches, and tasks get them. The one that orders shingles has more slots, as
# one that holds many tells rare shingles from frequent ones no more.
_SLOT_BITS = (16, 20)
_RANK_BITS = 23
_PARTS = 16
# Bytes of a key with its document, and of a list's entry.
_KEY_BYTES = 16
_ENTRY_BYTES = 8
# A set with more 2-subsets is priced by their bytes alone.
_PAIRS = 1 << 12
# Keys that a task ties at once, and lists that it ties though none of them may link.
_KEY_CHUNK = 1 << 20
_MANY_LOWER = 16
# Shingles in a group that is verified at once; larger groups are cut in blocks.
_BLOCK = 800_000
# Shingles that are moved at once whatever the sets have; beyond, a quarter of the sets' a round.
_ROUND = 1 << 26

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_WEIGHTS = [_U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                            0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers, one to one."""
    x = (x ^ (x >> _U(30))) * _WEIGHTS[0]
    x = (x ^ (x >> _U(27))) * _WEIGHTS[1]
    return x ^ (x >> _U(31))


@functools.cache
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, and the powers of the base and of its inverse."""
    powers = np.cumprod(np.full(size, _BASE))
    inverse = np.cumprod(np.full(size, _INVERSE))
    return mix(np.arange(1, 257, dtype=_U)), powers, inverse


def _chunk_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words of a piece of text, and their hashes."""
    octets = np.frombuffer(data, dtype=np.uint8)
    gap = np.concatenate([[True], _SPACE[octets], [True]])
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    ends = np.flatnonzero(~gap[:-1] & gap[1:])
    byte, powers, inverse = _tables(1 << max(20, len(data).bit_length()))
    total = np.zeros(len(octets) + 1, dtype=_U)
    np.cumsum(byte[octets] * powers[: len(octets)], out=total[1:])
    words = (total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U)
    return starts, mix(words)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of some size, cut at white space."""
    at = 0
    while len(text) - at > _TEXT_CHUNK:
        cut = max(text.rfind(c, at, at + _TEXT_CHUNK) for c in (b" ", b"\n"))
        if cut <= at:
            found = [p for c in (b" ", b"\n") if (p := text.find(c, at + _TEXT_CHUNK)) >= 0]
            cut = min(found, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def shingle_sets(texts: Sequence[bytes], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text, A-Z lower-cased."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if len(text) > _TEXT_CHUNK:
            yield from _group_sets(group, width)
            group, size = [], 0
            words = [_chunk_words(p)[1] for p in _pieces(text.lower())]
            yield _one_set(np.concatenate(words), width)
            continue
        if size + len(text) > _TEXT_CHUNK:
            yield from _group_sets(group, width)
            group, size = [], 0
        group.append(text.lower())
        size += len(text) + 1
    yield from _group_sets(group, width)


def _group_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    starts, words = _chunk_words(b" ".join(texts))
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    at = np.searchsorted(starts, edges)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield _one_set(words[lo:hi], width)


def _one_set(words: np.ndarray, width: int) -> np.ndarray:
    if not len(words):
        return words
    n = min(len(words), width)
    total = np.full(len(words) - n + 1, n, dtype=_U)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * (_WEIGHTS[k % 5] + _U(2 * (k // 5)))
    return np.unique(mix(total))


def _needed(n: np.ndarray | int) -> np.ndarray | int:
    """Overlap that a set of this size has with any it is linked to."""
    return -(-PERCENT * n // 100)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


# --- 1. how many shingles of a document occur elsewhere ---

_SENT = "bucket int, batch long, n_docs int, hashes binary, counts binary, ids binary, sizes binary"


def _send(buckets: int):
    bits = buckets.bit_length() - 1

    def block(batch_id: int, ids: list[int | None], sets: list[np.ndarray]) -> Iterator[tuple]:
        """Hashes by bucket, each once. What a block has twice is known to be shared.

        They go in the order of their documents, with how many each has: a byte or less for a
        document, where the document's number would be two for every hash. Those that the
        block has twice come last, as of one more document.
        """
        sizes = np.array([len(s) for s in sets], dtype=np.int32)
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        if bits:
            every >>= _U(32 - bits)
        else:
            every >>= _U(32)
        new = np.append(True, every[1:] != every[:-1])[: len(every)]
        alone = new & np.append(new[1:], True)[: len(every)]
        shared = np.bincount(owner[~alone], minlength=len(sets)).astype(np.int32)
        hashes = every[new]
        docs = np.where(alone, owner, np.uint16(len(sets)))[new]
        cuts = np.searchsorted(hashes, np.arange(buckets + 1, dtype=_U) << _U(32))
        low = (hashes & _U(0xFFFFFFFF)).astype(np.uint32)
        unnamed = np.array([i is None for i in ids], dtype=np.int32)
        names = np.array([i or 0 for i in ids], dtype=np.int64)
        info = (names.tobytes(), np.stack([sizes, shared, unnamed]).tobytes())
        for p in range(buckets):
            lo, hi = cuts[p], cuts[p + 1]
            own = info if p == batch_id % buckets else (None, None)
            mine = low[lo:hi][np.argsort(docs[lo:hi], kind="stable")]
            counts = _packed_counts(np.bincount(docs[lo:hi], minlength=len(sets) + 1))
            yield p, batch_id, len(ids), mine.tobytes(), counts, *own

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids: list[int | None] = []
        sets: list[np.ndarray] = []
        size = 0
        schema = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("n_docs", pa.int32())]
                           + [(n, pa.binary()) for n in ("hashes", "counts", "ids", "sizes")])

        def out() -> pa.RecordBatch:
            rows = list(zip(*block(number, ids, sets), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema
            )

        for batch in batches:
            own = zip(batch.column(0).to_pylist(), shingle_sets(_texts(batch, 1)), strict=True)
            for doc_id, found in own:
                ids.append(doc_id)
                sets.append(found)
                size += len(found)
                if size >= _SORT_CHUNK or len(ids) >= _MANY - 1:
                    yield out()
                    number += 1
                    ids, sets, size = [], [], 0
        if ids:
            yield out()

    return run


def _packed_counts(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.int32).tobytes()


def _counts_of(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.uint8 if len(packed) == n else np.int32)


def _match(table: pa.Table) -> pa.Table:
    """In a bucket: how many hashes of each document other blocks have, too."""
    hashes = [np.frombuffer(x, dtype=np.uint32) for x in table["hashes"].to_pylist()]
    owners = [
        np.repeat(np.append(np.arange(n, dtype=np.uint16), np.uint16(_MANY)), _counts_of(x, n + 1))
        for n, x in zip(table["n_docs"].to_pylist(), table["counts"].to_pylist(), strict=True)
    ]
    source = np.repeat(np.arange(len(hashes), dtype=np.int32), [len(h) for h in hashes])
    every, docs = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(every, kind="stable")
    every = every[order]
    new = np.append(True, every[1:] != every[:-1]) if len(every) else np.zeros(0, dtype=bool)
    alone = new & np.append(new[1:], True) if len(every) else new
    shared = order[~alone]
    shared = shared[docs[shared] != _MANY]
    counts = []
    by_source = np.argsort(source[shared], kind="stable")
    shared = shared[by_source]
    edges = np.searchsorted(source[shared], np.arange(len(hashes) + 1))
    for i, n in enumerate(table["n_docs"].to_pylist()):
        own = np.bincount(docs[shared[edges[i] : edges[i + 1]]], minlength=n)
        counts.append(_packed_counts(own))
    return pa.table(
        {
            "batch": table["batch"],
            "n_docs": table["n_docs"],
            "counts": pa.array(counts, pa.binary()),
            "ids": table["ids"],
            "sizes": table["sizes"],
        }
    )


def _total(table: pa.Table) -> pa.Table:
    """Of a block of documents: ids, set sizes, shared shingles."""
    n = table["n_docs"][0].as_py()
    rows = table["ids"].to_pylist()
    at = next(i for i, x in enumerate(rows) if x is not None)
    numbers = np.frombuffer(table["sizes"][at].as_py(), dtype=np.int32).reshape(3, n)
    sizes, shared, unnamed = numbers
    ids = pa.array(np.frombuffer(rows[at], dtype=np.int64), mask=unnamed == 1)
    shared = shared.astype(np.int64)
    for counts in table["counts"].to_pylist():
        shared = shared + _counts_of(counts, n)
    return pa.table({"doc_id": ids, "n_shingles": sizes.astype(np.int64), "shared": shared})


def shared_shingles(base: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, shared)``: set sizes, and how many elements occur elsewhere.

    Hashes are compared by 32 bits and the bucket's: shares can only come out too high.
    """
    spark = base.sparkSession
    buckets = 1 << max(3, (partitions(spark) - 1).bit_length())
    sent = base.mapInArrow(_send(buckets), _SENT)
    matched = sent.groupBy("bucket").applyInArrow(
        _match, "batch long, n_docs int, counts binary, ids binary, sizes binary"
    )
    return matched.groupBy("batch").applyInArrow(
        _total, "doc_id long, n_shingles long, shared long"
    )


# --- 2. representatives of equal sets ---


_DIGESTS = "doc_id long, own binary, n_shingles long, digest binary"
_SETS = "doc_id long, digest binary, n long, hashes binary"


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row the text's digest, and the size and the digest of its set."""
    for batch in batches:
        texts = _texts(batch, 1)
        sets = [(len(s), _digest(s)) for s in shingle_sets(texts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                pa.array([n for n, _ in sets], pa.int64()),
                pa.array([d for _, d in sets], pa.binary()),
            ],
            names=["doc_id", "own", "n_shingles", "digest"],
        )


def _set_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets with their digests, rows of a batch that repeat an id and a set once."""
    for batch in batches:
        found = {}
        for doc_id, own in zip(batch.column(0).to_pylist(), shingle_sets(_texts(batch, 1)), strict=True):
            found.setdefault((doc_id, _digest(own)), own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in found], pa.int64()),
                pa.array([d for _, d in found], pa.binary()),
                pa.array([len(x) for x in found.values()], pa.int64()),
                pa.array([x.tobytes() for x in found.values()], pa.binary()),
            ],
            names=["doc_id", "digest", "n", "hashes"],
        )


# --- 3. keys under which sets can meet ---


def _counts(keys: Callable[[np.ndarray], Sequence[np.ndarray]], kinds: int, bits: int, kind: type):
    """How many keys of each kind fall on each slot, of all sets of a task."""
    most = np.iinfo(kind).max

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((kinds, 1 << bits), dtype=kind)
        for batch in batches:
            for x in batch.column(2).to_pylist():
                for own, found in zip(counts, keys(np.frombuffer(x, dtype=_U)), strict=True):
                    at, n = np.unique(_slot(found, bits), return_counts=True)
                    own[at] += np.minimum(n, most - own[at]).astype(kind)
        task = TaskContext.get().partitionId()
        parts = [p.tobytes() for p in np.split(counts.ravel(), _PARTS * kinds)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(parts)), pa.int32()),
                pa.array([task % 32] * len(parts), pa.int32()),
                pa.array(parts, pa.binary()),
            ],
            names=["part", "salt", "counts"],
        )

    return run


def _add_up(given: type, wanted: type):
    most = np.iinfo(wanted).max

    def run(table: pa.Table) -> pa.Table:
        total = np.int64(0)
        for x in table["counts"].to_pylist():
            total = np.minimum(total + np.frombuffer(x, dtype=given), most)
        return pa.table(
            {
                "part": table["part"][:1],
                "salt": table["salt"][:1],
                "counts": pa.array([total.astype(wanted).tobytes()], pa.binary()),
            }
        )

    return run


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U(64 - bits)).astype(np.int64)


def _sketch(
    sets: DataFrame, keys, kinds: int, bits: int, kind: type = np.uint32, total: type = np.uint32
) -> np.ndarray:
    """Counts by kind and slot, for any corpus: no more than ``kind`` in a task, ``total`` in all."""
    form = "part int, salt int, counts binary"
    rows = sets.mapInArrow(_counts(keys, kinds, bits, kind), form)
    rows = rows.groupBy("part", "salt").applyInArrow(_add_up(kind, total), form)
    rows = rows.groupBy("part").applyInArrow(_add_up(total, total), form)
    parts = {r.part: np.frombuffer(r.counts, dtype=total) for r in rows.collect()}
    if not parts:
        return np.zeros((kinds, 1 << bits), dtype=total)
    return np.concatenate([parts[i] for i in range(_PARTS * kinds)]).reshape(kinds, -1)


def _rank(sets: DataFrame, shingles: int) -> np.ndarray:
    """Of each slot how frequent its shingles are, as a power of two."""
    bits = min(max(int(shingles).bit_length(), _SLOT_BITS[0]), _RANK_BITS)
    counters = _sketch(sets, lambda hashes: [hashes], 1, bits, np.uint8, np.uint16)[0]
    return np.ceil(np.log2(counters + np.float32(1))).astype(np.uint8)


def _size_class(n: np.ndarray | int) -> np.ndarray | int:
    """Classes of set sizes, at most four to a doubling."""
    return np.floor(4 * np.log2(n)).astype(np.int64)


def _ordered(hashes: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """The first elements in the global order: rare ones first, by hash among equals."""
    if length >= len(hashes):
        length = len(hashes)
    places = _slot(hashes, len(rank).bit_length() - 1)
    return hashes[np.lexsort((hashes, rank[places]))[:length]]


def _element_keys(prefix: np.ndarray, length: int) -> np.ndarray:
    return mix(prefix[:length] ^ _WEIGHTS[3])


def _pair_keys(prefix: np.ndarray) -> np.ndarray:
    a, b = np.triu_indices(len(prefix), 1)
    return mix(prefix[a] * _WEIGHTS[2] + mix(prefix[b]))


def _both_keys(rank: np.ndarray):
    """The keys of a set as a large one, and as a small one unless they are very many."""

    def keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(hashes)
        if _needed(n) < 2:
            return hashes[:0], hashes[:0]
        length = n - _needed(n) + 1
        prefix = _ordered(hashes, rank, length + 1)
        few = len(prefix) * (len(prefix) - 1) // 2 <= _PAIRS
        return _element_keys(prefix, length), _pair_keys(prefix) if few else hashes[:0]

    return keys


def _costs(rank: np.ndarray, lists: np.ndarray):
    """Bytes per size class, with 2-subsets and with single elements as keys.

    A slot has the key's list and on average as many others as all slots have; over many keys
    what is too high and what is too low cancel out.
    """
    keys = _both_keys(rank)
    bits = lists.shape[1].bit_length() - 1
    others = lists.mean(axis=1)

    def price(kind: int, found: np.ndarray) -> float:
        entries = lists[kind][_slot(found, bits)].sum() - len(found) * (others[kind] + 1)
        return _KEY_BYTES * len(found) + _ENTRY_BYTES * float(entries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        light: dict[int, float] = {}
        heavy: dict[int, float] = {}
        for batch in batches:
            for x in batch.column(2).to_pylist():
                hashes = np.frombuffer(x, dtype=_U)
                elements, pairs = keys(hashes)
                if not len(elements):
                    continue
                kind = int(_size_class(len(hashes)))
                many = len(elements) * (len(elements) + 1) // 2
                light[kind] = light.get(kind, 0.0) + (
                    price(1, pairs) if len(pairs) else _KEY_BYTES * many
                )
                heavy[kind] = heavy.get(kind, 0.0) + price(0, elements)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(light), pa.int64()),
                pa.array(list(light.values()), pa.float64()),
                pa.array([heavy[k] for k in light], pa.float64()),
            ],
            names=["kind", "light", "heavy"],
        )

    return run


def _boundary(sets: DataFrame, rank: np.ndarray) -> int:
    """The largest size class that enumerates subsets, by least total cost."""
    lists = _sketch(sets, _both_keys(rank), 2, min(len(rank).bit_length() - 1, _SLOT_BITS[1]))
    rows = (
        sets.mapInArrow(_costs(rank, lists), "kind long, light double, heavy double")
        .groupBy("kind")
        .agg(F.sum("light").alias("light"), F.sum("heavy").alias("heavy"))
        .orderBy("kind")
        .collect()
    )  # a row per class
    best, at = sum(r.heavy for r in rows), -1
    cost = best
    for r in rows:
        cost += r.light - r.heavy
        if cost < best:
            best, at = cost, r.kind
    return at


def _window_starts() -> np.ndarray:
    """The least size of each window: no set is linked to one beyond the next window."""
    starts = [1]
    while starts[-1] < 1 << 48:
        starts.append(max(starts[-1] + 1, 100 * (starts[-1] - 1) // PERCENT + 1))
    return np.array(starts)


_WINDOWS = _window_starts()


def _window(n: np.ndarray | int) -> np.ndarray | int:
    return np.searchsorted(_WINDOWS, n, side="right")


def _document_keys(hashes: np.ndarray, rank: np.ndarray, boundary: int) -> list[np.ndarray]:
    """Keys of a set in its own window, then in the next one.

    Of two linked sets, the larger has the first element of both in its prefix. The smaller has
    it in a shorter prefix, as it must share more of itself with a larger one.
    """
    n = len(hashes)
    needed = _needed(n)
    # A set that must share all but less than one element meets only its equal.
    if needed < 2:
        return [hashes[:0], hashes[:0]]
    length = n - needed + 1
    prefix = _ordered(hashes, rank, length + 1)
    small = int(_size_class(n)) <= boundary
    # Sets over the boundary, and small ones that can be linked with them.
    large = int(_size_class(max(n, 100 * n // PERCENT))) > boundary
    found = []
    for later, own in enumerate((length, n - _needed_of_both(n) + 1)):
        keys = []
        if large:
            keys.append(_element_keys(prefix, own))
        if small:
            keys.append(_pair_keys(prefix[: own + 1]))
        found.append(np.concatenate(keys) ^ mix(np.array([_window(n) + later], dtype=_U)))
    return found


def _needed_of_both(n: int) -> int:
    """Overlap that a set of this size has with any at least as large that it is linked to."""
    return -(-2 * PERCENT * n // (100 + PERCENT))


_MET = "bucket int, keys binary, nodes binary, u binary, v binary"


def _keys(rank: np.ndarray, boundary: int, buckets: int):
    """Keys with the nodes that have them, by bucket; those that meet in a task are tied there.

    A node is twice a set's mark, plus one in the later window. There a set meets only sets of
    the window itself, so a list without any makes no ties; if it is long, it is tied all the
    same, as a frequent key must not send all its entries to one bucket.
    """
    bits = buckets.bit_length() - 1

    def tied(number: int, keys: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
        owners = np.repeat(np.array(nodes, dtype=np.int64), [len(k) for k in keys])
        every, owners, head, first, count = _lists(np.concatenate(keys), owners)
        tie = ((head & 1) == 0) | (count > _MANY_LOWER)
        u, v = _tied(owners, head, tie)
        every, owners = every[first | ~tie], owners[first | ~tie]
        cuts = [np.searchsorted(every, _U(p << (64 - bits))) for p in range(1, buckets)]
        low = (every >> _U(32 - bits)).astype(np.uint32)
        own = number % buckets
        return pa.RecordBatch.from_arrays(
            [
                pa.array(range(buckets), pa.int32()),
                pa.array([x.tobytes() for x in np.split(low, cuts)], pa.binary()),
                pa.array([x.tobytes() for x in np.split(owners, cuts)], pa.binary()),
                pa.array([u.tobytes() if p == own else None for p in range(buckets)], pa.binary()),
                pa.array([v.tobytes() if p == own else None for p in range(buckets)], pa.binary()),
            ],
            names=["bucket", "keys", "nodes", "u", "v"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        keys: list[np.ndarray] = []
        nodes: list[int] = []
        size = 0
        for batch in batches:
            for mark, x in zip(
                batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                own = _document_keys(np.frombuffer(x, dtype=_U), rank, boundary)
                keys += own
                nodes += [2 * mark, 2 * mark + 1]
                size += sum(map(len, own))
                if size > _KEY_CHUNK:
                    yield tied(number, keys, nodes)
                    keys, nodes, size = [], [], 0
                    number += 1
        if size:
            yield tied(number, keys, nodes)

    return run


def _lists(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries by key, with the node at the head of the list, whether it is that, and the length.

    At the head is one of the window itself, if there is any.
    """
    order = np.lexsort((nodes & 1, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(keys)))
    return keys, nodes, np.repeat(nodes[at], count), first, np.repeat(count, count)


def _tied(nodes: np.ndarray, head: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tie = tie & (nodes != head)
    return _forest(nodes[tie], head[tie])


def _meet(table: pa.Table) -> pa.Table:
    """In a bucket: edges between nodes that have a key in common.

    Keys are compared by 32 bits and the bucket's: there can only be too many edges.
    """

    def column(name: str, kind: type) -> np.ndarray:
        found = [np.frombuffer(x, dtype=kind) for x in table[name].to_pylist() if x is not None]
        return np.concatenate(found) if found else np.zeros(0, dtype=kind)

    _, nodes, head, _, _ = _lists(column("keys", np.uint32), column("nodes", np.int64))
    u, v = _tied(nodes, head, (head & 1) == 0)
    u, v = np.append(u, column("u", np.int64)), np.append(v, column("v", np.int64))
    u, v = _forest(u, v)
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _meetings(sets: DataFrame, rank: np.ndarray, boundary: int) -> DataFrame:
    """``(u, v)``: nodes that meet, as edges that keep their components; ``sets`` have a mark first."""
    buckets = 1 << max(3, (partitions(sets.sparkSession) - 1).bit_length())
    sent = sets.mapInArrow(_keys(rank, boundary, buckets), _MET)
    return sent.groupBy("bucket").applyInArrow(_meet, "u long, v long")


# --- 4. exact overlaps inside groups ---

_FOUND = "u long, v long, n_links long"


def _verify(table: pa.Table) -> pa.Table:
    """Links of a group: edges that keep its components, and numbers of links."""
    ids = table["doc_id"].to_numpy()
    side = table["side"].to_numpy()
    cross = table["i"][0].as_py() != table["j"][0].as_py()
    weight = table["copies"].to_numpy()
    sets = [np.frombuffer(x, dtype=_U) for x in table["hashes"].to_pylist()]
    sizes = np.array([len(s) for s in sets])
    # Of two sets of a window, one at least must be its own.
    later = table["later"].to_numpy() if "later" in table.column_names else np.zeros(len(sizes), int)
    window = _window(sizes) + later if "later" in table.column_names else later
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    every = np.concatenate(sets)
    # Inverted lists of the elements that several sets have.
    order = np.argsort(every, kind="stable").astype(np.int32)
    lists = owner[order]
    every = every[order]
    new = np.append(True, every[1:] != every[:-1])
    del owner, every, sets
    element = np.empty(len(order), dtype=np.int32)
    element[order] = np.cumsum(new, dtype=np.int32) - 1
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(order)))
    del order, new
    at = np.concatenate([[0], np.cumsum(sizes)])

    parent = np.arange(len(sizes))
    links = np.zeros(len(sizes), dtype=np.int64)
    edges: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(sizes)):
        own = element[at[a] : at[a + 1]]
        own = own[count[own] > 1]
        n = count[own]
        if len(own) < _needed(int(sizes[a])):
            continue
        ends = np.cumsum(n)
        scan = np.arange(ends[-1]) + np.repeat(begin[own] - ends + n, n)
        overlap = np.bincount(lists[scan], minlength=len(sizes))
        linked = 100 * overlap >= PERCENT * (sizes + sizes[a] - overlap)
        linked[a] = False
        linked &= (window == window[a]) & ((later == 0) | (later[a] == 0))
        if cross:
            linked &= side != side[a]
        partners = np.flatnonzero(linked)
        links[a] += weight[partners].sum()
        for b in partners[partners > a].tolist():
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((a, b))
    some = np.flatnonzero(links)
    u = [ids[a] for a, _ in edges] + ids[some].tolist()
    v = [ids[b] for _, b in edges] + [None] * len(some)
    n = [None] * len(edges) + links[some].tolist()
    kind = pa.int64()
    return pa.table({"u": pa.array(u, kind), "v": pa.array(v, kind), "n_links": pa.array(n, kind)})


def _groups(meets: DataFrame, classes: DataFrame) -> DataFrame:
    """Sets with the groups they are verified in; a set of a large group has several."""
    grouped = store(components(meets), "join-groups")
    by_mark = classes.select(F.col("mark").alias("__mark"), "digest", "node", "copies", "n")
    sized = store(
        grouped.select(
            F.shiftright("node", 1).alias("mark"),
            F.col("node").bitwiseAND(F.lit(1)).cast("int").alias("later"),
            "root",
        )
        .join(by_mark, F.col("mark") == F.col("__mark"))
        .drop("__mark"),
        "join-sizes",
    )
    whole = sized.groupBy("root").agg(F.sum("n").alias("total"), F.min("later").alias("none"))
    bundles = (sized.agg(F.sum("n")).first()[0] or 0) // _BLOCK + 1
    blocks = F.ceil(F.col("total") / _BLOCK)
    # Sets that no set of the window itself has met are in no group.
    placed = attach(sized, whole.filter("none = 0"), ["root"]).filter("total IS NOT NULL").select(
        "digest",
        "mark",
        "node",
        "copies",
        "later",
        "n",
        F.when(blocks == 1, -1 - F.pmod(F.xxhash64("root"), F.lit(bundles)))
        .otherwise(F.col("root"))
        .alias("place"),
        F.pmod(F.xxhash64("node"), blocks).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    )
    placed = store(
        placed.select(
            "digest",
            "mark",
            F.col("node").alias("doc_id"),
            "copies",
            "later",
            "n",
            "place",
            "side",
            F.least("side", "other").alias("i"),
            F.greatest("side", "other").alias("j"),
        ),
        "join-places",
    )
    discard(grouped, sized)
    return placed


def _rounds(placed: int, shingles: int) -> int:
    """In how many rounds groups are verified.

    A round moves each of its sets twice. Together they may be moved many times, but at once
    no more than half of what the stored sets have on the disks.
    """
    return 1 if placed <= _ROUND else -(-4 * placed // shingles)


def _found(sets: DataFrame, classes: DataFrame, placed: DataFrame, shingles: int) -> DataFrame:
    """The links of all groups; ``sets`` may have rows of other documents, and some repeated."""
    rounds = _rounds(placed.agg(F.sum("n")).first()[0] or 0, shingles)
    named = classes.select(F.col("digest").alias("__digest"), "rep")
    number = F.pmod(F.xxhash64("place", "i", "j"), F.lit(rounds))
    # In a form that Spark takes for no key of the join: sets are dealt once, by their digests.
    same = F.when(F.col("rep").isNull(), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.col("rep"))

    def part(k: int) -> DataFrame:
        own = placed.filter(number == k)
        wanted = sets.filter(may_be_in(own, "mark")(F.col("mark")))
        once = (
            wanted.join(named, F.col("digest") == F.col("__digest"))
            .filter(same)
            .dropDuplicates(["digest"])
            .select(F.col("digest").alias("__digest"), "hashes")
        )
        rows = own.join(once, F.col("digest") == F.col("__digest")).select(
            "place", "i", "j", "side", "later", "doc_id", "copies", "hashes"
        )
        return rows.groupBy("place", "i", "j").applyInArrow(_verify, _FOUND)

    return store_each((part(k) for k in range(rounds)), "join-found")


def _linked(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows' sets with ``likely``, and the links of the rows of likely ids.

    The second is ``(doc_id, own, n_shingles, rep, root, n_links)`` by row: ``own`` is the text's
    digest, ``root`` a number of the component, ``rep`` the smallest id with an equal set. Sets are
    numbered by themselves, so texts that share an id or have none are linked by their own.
    """
    with small_batches(base.sparkSession), short_shuffles(base.sparkSession):
        return _linked_in_batches(base)


def _linked_in_batches(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    stats = store(
        shared_shingles(base).withColumn(
            "likely", F.expr(f"n_shingles > 0 AND 100 * shared >= {PERCENT} * n_shingles")
        ),
        "join-stats",
    )
    chosen = store(
        only_ids(
            base,
            "doc_id",
            stats.filter("likely"),
            "doc_id",
            lambda rows: rows.mapInArrow(_digests, _DIGESTS),
        ),
        "join-digests",
    )
    # A set's mark is small, so that it takes little room beside a key; two sets may share one.
    classes = store(
        chosen.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("copies"),
            F.max("n_shingles").alias("n"),
        )
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("mark", _mark()),
        "join-classes",
    )
    # Rows of other documents that pass the test, and repeated ones, are told apart when they move.
    sets = store(
        base.filter(may_be_in(classes, "rep")(F.col("doc_id")))
        .mapInArrow(_set_rows, _SETS)
        .filter("n > 0")
        .withColumn("mark", _mark()),
        "join-sets",
    )
    marked = sets.select("mark", "n", "hashes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    rank = _rank(marked, shingles)
    placed = _groups(_meetings(marked, rank, _boundary(marked, rank)), classes)
    found = _found(sets, classes, placed, shingles)
    discard(sets, placed)

    roots = components(found.filter("v IS NOT NULL").select("u", "v"))
    links = found.filter("v IS NULL").groupBy("u").agg(F.sum("n_links").alias("n_links"))
    tied = attach(
        attach(classes, roots, ["node"]), links.withColumnRenamed("u", "node"), ["node"]
    ).select(
        "digest",
        "rep",
        F.coalesce("root", "node").alias("root"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    members = store(attach(chosen, tied, ["digest"]).drop("digest"), "join-members")
    discard(chosen, classes, found)
    return stats, members


def _mark() -> Column:
    return F.shiftrightunsigned(F.xxhash64("digest"), 24)


def _by_ids(members: DataFrame) -> DataFrame:
    """``(root, top)`` of roots that are tied by an id of several texts."""
    held = members.filter("doc_id IS NOT NULL AND root IS NOT NULL")
    least = held.groupBy("doc_id").agg(F.min("root").alias("v"), F.max("root").alias("__most"))
    edges = store(
        attach(held, least.filter("v < __most"), ["doc_id"])
        .filter("v < root")
        .select(F.col("root").alias("u"), "v")
        .distinct(),
        "join-ids",
    )
    if edges.isEmpty():
        return edges.select(F.col("u").alias("root"), F.col("v").alias("top"))
    return components(edges).select(F.col("node").alias("root"), F.col("root").alias("top"))


def linked_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, own, root)`` of rows that may be linked: rows with equal ``root`` are a component.

    Components are those of texts, whatever their ids; ``own`` is the MD5 digest of the text.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _linked(base)[1].filter("root IS NOT NULL").select("doc_id", "own", "root")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` for every document.

    Words lie between white space (space, 0x09 to 0x0D), A-Z lower-cased; a document's set has
    its distinct 5-word shingles, or the whole sequence where there are fewer words. Documents
    are linked when the sets' similarity is 80 % or more. ``component_id`` is the smallest id
    reachable by links, ``n_links`` the number of other documents linked directly. A text that
    is NULL or has no words has an empty set and no links. Rows that repeat an id are linked
    by their own texts and share the component. A row with a NULL id is linked like others,
    shares nothing with other such rows, and names no component: it has a NULL one if it
    reaches no id. Other columns are ignored; no rows give no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stats, members = _linked(base)
    tied = attach(members, _by_ids(members), ["root"]).withColumn("top", F.coalesce("top", "root"))
    names = tied.filter("top IS NOT NULL").groupBy("top").agg(F.min("rep").alias("name"))
    rows = attach(tied, names, ["top"])
    by_id = rows.groupBy("doc_id").agg(F.min("name").alias("by_id"))
    linked = attach(rows, by_id, ["doc_id"]).select(
        "doc_id",
        "n_shingles",
        # A row without an id has only its own text's component.
        F.when(F.col("doc_id").isNull(), F.col("name"))
        .otherwise(F.coalesce("by_id", "doc_id"))
        .alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    likely = stats.filter("likely").select(F.col("doc_id").alias("__id")).distinct()
    rest = stats.join(likely, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti").select(
        "doc_id",
        "n_shingles",
        F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return linked.unionByName(rest)


def op3_heavy_light_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir))
