"""Substring deduplication with an enhanced suffix array and its common-prefix interval tree.

Sorting all suffixes of a corpus is not needed to find repeats of 100 bytes. Every 100-byte
string has an anchor, the 32-byte gram of least hash in it, so equal strings have equal anchors
at the same offset. The suffixes that start at anchors are sorted, those of one gram together:

1. Exact copies of whole documents are set aside by digest.
2. Anchors' hashes go to hash ranges in sorted blocks; what comes back says which anchors of a
   document have their gram elsewhere, too. The others can't be part of a repeat.
3. For those, the text around the anchor goes to a bucket of its gram. A bucket sorts the
   suffixes, takes common-prefix lengths and scans them with a stack: an interval is a group
   of occurrences equal to the right up to its depth. The same is done to the left inside an
   interval, where occurrences differ in what comes before: each left-diverse group is a
   repeat, maximal within the contexts compared. All but the earliest are covered.
4. Covered bytes are cut out of the documents that have any.

Groups end at the edge of the anchors' contexts (at most 168 bytes), so a longer passage is
several, and occurrences set aside before (step 1, equal contexts of a task) are not in them.
They serve to find what is covered; only the covered spans are returned, and those are exact.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import documents, may_be_in, partitions, small_batches, store
from txmon.operators.joins import attach

LENGTH = 100
GRAM = 32
# Grams in a string of LENGTH bytes.
_GRAMS = LENGTH - GRAM + 1
# Text hashed at once: some hundred bytes of arrays for each of its bytes.
_TEXT_CHUNK = 1 << 18
_SEND_CHUNK = 1 << 18
_MANY = 0xFFFFFFFF
# Spans of a bucket that are held before overlapping ones are put together.
_SPANS_HELD = 1 << 18
# Contexts of a bucket that are compared at once, and rows of bytes that are hashed at once.
_COMPARED = 1 << 15
_ROWS = 1 << 14
# Bytes of context that a task packs at once, and what an entry takes besides its text.
_PACK = 1 << 23
_ENTRY = 500

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_PLACE = _U((1 << 22) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.cache
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    powers = np.cumprod(np.full(size, _BASE))
    return _mix(np.arange(1, 257, dtype=_U)), powers, np.cumprod(np.full(size, _INVERSE))


def _anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of each string of LENGTH bytes in a piece of text: its anchor's place; and gram hashes."""
    octets = np.frombuffer(data, dtype=np.uint8)
    byte, powers, inverse = _tables(1 << max(19, len(data).bit_length()))
    total = np.zeros(len(octets) + 1, dtype=_U)
    np.cumsum(byte[octets] * powers[: len(octets)], out=total[1:])
    n = len(octets) - GRAM + 1
    grams = _mix((total[GRAM:] - total[:n]) * inverse[:n])
    # The least hash in each window, by place among equals: minima from both block ends.
    value = (grams & ~_PLACE) | np.arange(n, dtype=_U)
    padded = np.full(-(-n // _GRAMS) * _GRAMS, ~_U(0))
    padded[:n] = value
    blocks = padded.reshape(-1, _GRAMS)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    many = n - _GRAMS + 1
    least = np.minimum(behind[:many], ahead[_GRAMS - 1 : _GRAMS - 1 + many])
    return (least & _PLACE).astype(np.int64), grams


def anchors(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per text: gram hash, place, first string and number of strings of every anchor."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if size + len(text) > _TEXT_CHUNK:
            yield from _group_anchors(group)
            group, size = [], 0
        if len(text) > _TEXT_CHUNK:
            parts = []
            for at in range(0, len(text) - LENGTH + 1, _TEXT_CHUNK):
                own = next(_group_anchors([text[at : at + _TEXT_CHUNK + LENGTH - 1]]))
                parts.append((own[0], own[1] + at, own[2] + at, own[3]))
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            continue
        group.append(text)
        size += len(text)
    yield from _group_anchors(group)


def _group_anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    empty = np.zeros(0, dtype=np.int64)
    if sizes.sum() < LENGTH:
        for _ in texts:
            yield empty.astype(_U), empty, empty, empty
        return
    ends = np.cumsum(sizes)
    place, grams = _anchors(b"".join(texts))
    for begin, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        own = place[begin : max(begin, end - LENGTH + 1)]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else empty
        many = np.diff(np.append(first, len(own)))
        at = own[first]
        # Anchors are least hashes, nearly all near 0: mixed again they are spread evenly.
        yield _mix(grams[at]), at - begin, first, many


def _octets(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


# --- 2. anchors whose gram occurs elsewhere ---

_SENT = "bucket int, batch long, hashes binary, places binary, ids binary, sizes binary"


def _send(buckets: int):
    bits = buckets.bit_length() - 1

    def block(number: int, ids: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        """Hashes by bucket, each once. What a block has twice is known to be repeated."""
        every = np.concatenate(found) >> _U(32 - bits)
        order = np.argsort(every, kind="stable")
        every = every[order]
        new = np.append(True, every[1:] != every[:-1])[: len(every)]
        alone = new & np.append(new[1:], True)[: len(every)]
        again = np.sort(order[~alone]).astype(np.uint32)
        hashes = every[new]
        places = np.where(alone, order, _MANY)[new].astype(np.uint32)
        cuts = np.searchsorted(hashes, np.arange(buckets + 1, dtype=_U) << _U(32))
        low = (hashes & _U(0xFFFFFFFF)).astype(np.uint32)
        sizes = np.array([len(x) for x in found], dtype=np.uint32)
        # Ids go to one bucket, another for each block: also for the first ones of all tasks.
        turn = (number + 31 * (number >> 24)) % buckets
        rows = []
        for p in range(buckets):
            lo, hi = cuts[p], cuts[p + 1]
            own = (None, None)
            if p == turn:
                own = (
                    np.array(ids, dtype=np.int64).tobytes(),
                    np.concatenate([sizes, again]).tobytes(),
                )
            rows.append((p, number, low[lo:hi].tobytes(), places[lo:hi].tobytes(), *own))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        names = ["bucket", "batch", "hashes", "places", "ids", "sizes"]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids: list[int] = []
        found: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for doc_id, own in zip(
                batch.column(0).to_pylist(), anchors(_octets(batch, 1)), strict=True
            ):
                if len(own[0]):
                    ids.append(doc_id)
                    found.append(own[0])
                    size += len(own[0])
                if size >= _SEND_CHUNK:
                    yield block(number, ids, found)
                    number += 1
                    ids, found, size = [], [], 0
        if ids:
            yield block(number, ids, found)

    return run


def _match(table: pa.Table) -> pa.Table:
    """In a bucket: which entries of each block have their hash in another block."""
    hashes = [np.frombuffer(x, dtype=np.uint32) for x in table["hashes"].to_pylist()]
    places = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in table["places"].to_pylist()])
    source = np.repeat(np.arange(len(hashes), dtype=np.int32), [len(h) for h in hashes])
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    every = every[order]
    new = np.append(True, every[1:] != every[:-1])[: len(every)]
    alone = new & np.append(new[1:], True)[: len(every)]
    again = order[~alone]
    again = np.sort(again[places[again] != _MANY])
    cuts = np.searchsorted(source[again], np.arange(len(hashes) + 1))
    out = [places[again[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table(
        {
            "batch": table["batch"],
            "again": pa.array(out, pa.binary()),
            "ids": table["ids"],
            "sizes": table["sizes"],
        }
    )


def _gather(table: pa.Table) -> pa.Table:
    """Of a block of documents: numbers of the anchors to look at, for documents with any."""
    rows = table["ids"].to_pylist()
    at = next(i for i, x in enumerate(rows) if x is not None)
    ids = np.frombuffer(rows[at], dtype=np.int64)
    known = np.frombuffer(table["sizes"][at].as_py(), dtype=np.uint32)
    sizes, own = known[: len(ids)].astype(np.int64), known[len(ids) :]
    again = np.concatenate([own, *(np.frombuffer(x, dtype=np.uint32) for x in table["again"].to_pylist())])
    again = np.sort(again).astype(np.int64)
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(again, np.append(0, ends))
    some = np.flatnonzero(cuts[1:] > cuts[:-1])
    numbers = [
        (again[cuts[i] : cuts[i + 1]] - (ends[i] - sizes[i])).astype(np.uint32).tobytes()
        for i in some.tolist()
    ]
    return pa.table({"doc_id": ids[some], "numbers": pa.array(numbers, pa.binary())})


# --- 3. suffixes of one gram together ---

_PACKED = (
    "bucket int, salt int, doc_ids binary, starts binary, offsets binary, sizes binary, texts binary"
)
_SPANS = "doc_id long, start long, end long"


def _span_batch(doc_ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(x, dtype=np.int64)) for x in (doc_ids, starts, ends)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "end"])


def _pack(buckets: int):
    """Contexts of repeated anchors by bucket: for each, the text of all strings it anchors.

    What a task has seen before is not sent again: of equal contexts only the earliest is,
    the others are known to be covered and are sent as spans of their own, with no bucket.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = _octets(batch, 1)
            numbers = batch.column(2).to_pylist()
            # Earliest first, so that of equal contexts the first one met is the earliest.
            order = sorted(range(len(ids)), key=ids.__getitem__)
            seen: dict[bytes, tuple[int, int]] = {}
            rows: list[tuple] = []
            covered: list[tuple] = []
            size = 0
            ordered = [texts[i] for i in order]
            for i, text, (gram, place, first, many) in zip(order, ordered, anchors(ordered), strict=True):
                own = np.frombuffer(numbers[i], dtype=np.uint32)
                own = own[own < len(gram)]  # of another text, where texts share an id
                for g, p, f, m in zip(
                    gram[own].tolist(), place[own].tolist(), first[own].tolist(),
                    many[own].tolist(), strict=True,
                ):
                    context = text[f : f + m + LENGTH - 1]
                    key = context + (p - f).to_bytes(1)
                    if (met := seen.setdefault(key, (ids[i], f))) != (ids[i], f):
                        if met[0] < ids[i] or met[1] < f:
                            covered.append((ids[i], f, f + len(context)))
                            size += _ENTRY
                    else:
                        rows.append((g >> (64 - buckets), ids[i], f, p - f, context))
                        size += _ENTRY + 2 * len(context)
                    # Also inside a text, which may be of any length.
                    if size > _PACK:
                        yield _packed(rows, covered)
                        rows, covered, size, seen = [], [], 0, {}
            if rows or covered:
                yield _packed(rows, covered)

    return run


def _packed(rows: list[tuple], covered: list[tuple]) -> pa.RecordBatch:
    groups: dict[int, list[tuple]] = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    out = []
    for bucket, own in groups.items():
        _, doc_ids, starts, offsets, texts = zip(*own, strict=True)
        out.append(
            (
                bucket,
                np.array(doc_ids, dtype=np.int64).tobytes(),
                np.array(starts, dtype=np.int64).tobytes(),
                np.array(offsets, dtype=np.uint8).tobytes(),
                np.array([len(t) for t in texts], dtype=np.uint8).tobytes(),
                b"".join(texts),
            )
        )
    if covered:
        spans = _union(*(np.array(x, dtype=np.int64) for x in zip(*covered, strict=True)))
        out.append((-1, *(x.tobytes() for x in spans), b"", b""))
    salt = TaskContext.get().partitionId()
    names = ["bucket", "doc_ids", "starts", "offsets", "sizes", "texts"]
    kinds = [pa.int32(), *[pa.binary()] * 5]
    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
    # Rows without a bucket are dealt by task.
    salts = pa.array([salt if row[0] < 0 else 0 for row in out], pa.int32())
    return pa.RecordBatch.from_arrays(
        [columns[0], salts, *columns[1:]], names=[names[0], "salt", *names[1:]]
    )


def intervals(common: Sequence[int], least: int) -> Iterator[tuple[int, int, int]]:
    """``(lo, hi, depth)`` of a common-prefix interval tree with depths of ``least`` or more.

    ``common[i]`` is the length that sorted entries ``i`` and ``i + 1`` have in common. The
    stack holds open intervals, each deeper than the one below; children come before parents.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*common, -1]):
        lo = i
        while stack and stack[-1][1] > depth:
            lo, deep = stack.pop()
            yield lo, i + 1, deep
        if depth >= least and (not stack or stack[-1][1] < depth):
            stack.append((lo, depth))


def _sorted(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of byte strings, their ranks, and the lengths neighbours have in common."""
    order = np.array(sorted(range(len(parts)), key=parts.__getitem__), dtype=np.int64)
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    grid = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in parts), dtype=np.uint8)
    grid = grid.reshape(len(parts), width)[order] if width else np.zeros((len(parts), 0), np.uint8)
    common = np.zeros(max(0, len(parts) - 1), dtype=np.int64)
    for at in range(0, len(common), 1 << 16):
        a, b = grid[at : at + (1 << 16)], grid[at + 1 : at + 1 + (1 << 16)]
        differs = a[: len(b)] != b
        # Without any bytes there is nothing to differ in.
        found = np.where(differs.any(axis=1), differs.argmax(axis=1), width) if width else 0
        common[at : at + len(b)] = found
    sizes = sizes[order]
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    rank = np.empty(len(parts), dtype=np.int64)
    rank[order] = np.arange(len(parts))
    return order, rank, common


def maximal_repeats(
    rights: list[bytes], lefts: list[bytes], length: int = LENGTH
) -> Iterator[tuple[np.ndarray, int, int]]:
    """``(members, left, right)``: groups of occurrences equal that far to either side.

    ``rights`` are texts from the anchors on, ``lefts`` what comes before, reversed. A group
    can't be longer: its members differ in what follows and in what comes before, or end.
    Groups of at least ``length`` bytes, with all members; nested groups are given, too.
    """
    width = max(map(len, rights), default=0)
    order, _, common = _sorted(rights, width)
    _, left_rank, left_common = _sorted(lefts, max(map(len, lefts), default=0))
    by_left = np.argsort(left_rank)
    left_common = np.append(left_common, 0)
    for lo, hi, right in intervals(common.tolist(), GRAM):
        ranks = np.sort(left_rank[order[lo:hi]])
        # What neighbours of the interval have in common to the left.
        beside = np.minimum.reduceat(left_common, ranks)[:-1]
        need = length - right
        if beside.max(initial=-1) < need:
            continue
        members = by_left[ranks]
        for a, b, left in intervals(beside.tolist(), max(0, need)):
            yield members[a:b], left, right


def _cover(table: pa.Table) -> pa.Table:
    """Spans of a bucket that also start earlier."""
    if table["bucket"][0].as_py() < 0:
        spans = [np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table[c].to_pylist()])
                 for c in ("doc_ids", "starts", "offsets")]
        return pa.table(dict(zip(("doc_id", "start", "end"), spans, strict=True)))
    doc_ids, starts = (
        np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table[c].to_pylist()])
        for c in ("doc_ids", "starts")
    )
    offsets, sizes = (
        np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in table[c].to_pylist()]).astype(np.int64)
        for c in ("offsets", "sizes")
    )
    text = b"".join(table["texts"].to_pylist())
    spans = covered(doc_ids, starts, offsets, sizes, text)
    return pa.table(dict(zip(("doc_id", "start", "end"), spans, strict=True)))


def covered(
    doc_ids: np.ndarray, starts: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, text: bytes,
    most: int = _COMPARED,
) -> tuple[np.ndarray, ...]:
    """Spans of contexts that also start earlier; at most some ``most`` contexts are compared at once."""
    anchor = np.cumsum(sizes) - sizes + offsets
    place = starts + offsets
    age = np.empty(len(place), dtype=np.int64)
    by_age = np.lexsort((place, doc_ids))
    same = np.append(False, (np.diff(doc_ids[by_age]) == 0) & (np.diff(place[by_age]) == 0))
    # Entries of one place, as of a repeated row, have the same age.
    age[by_age] = np.maximum.accumulate(np.where(same, 0, np.arange(len(place))))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(place[:0],) * 3]
    size, room = 0, _SPANS_HELD
    octets = np.frombuffer(text, dtype=np.uint8)
    for known, own, left, right in _parts(octets, anchor, offsets, sizes - offsets, age, most):
        found = [(own, left, right)] if known else _later(text, anchor[own], left, right, age[own], own)
        for members, before, after in found:
            out.append((doc_ids[members], place[members] - before, place[members] + after))
            size += len(members)
            if size > room:
                # Nested groups cover the same bytes again and again.
                out = [_union(*(np.concatenate(x) for x in zip(*out, strict=True)))]
                size = len(out[0][0])
                room = max(_SPANS_HELD, 2 * size)
    return _union(*(np.concatenate(x) for x in zip(*out, strict=True)))


def _later(
    text: bytes, anchor: np.ndarray, left: np.ndarray, right: np.ndarray, age: np.ndarray, own: np.ndarray
) -> Iterator[tuple[np.ndarray, int, int]]:
    """Of each group of equal strings around anchors: all but the earliest."""
    rights, lefts = [], []
    for at, before, after in zip(anchor.tolist(), left.tolist(), right.tolist(), strict=True):
        rights.append(text[at : at + after])
        lefts.append(text[at - before : at][::-1])
    for members, before, after in maximal_repeats(rights, lefts):
        older = age[members]
        yield own[members[older > older.min()]], before, after


def _parts(
    octets: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray, age: np.ndarray,
    most: int,
) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """``(known, entries, left, right)``: contexts to compare, so that equal strings meet.

    Contexts of different grams need not meet. Those of a gram that has too many are cut: strings
    with ``low`` to ``high`` bytes before their anchor have some bytes around it in common, more
    the nearer the two bounds are, and meet by these. Of equal ones all but the earliest are known
    to be covered (``known``) and go no further, so what meets by a whole string is different.
    """
    todo = [(np.arange(len(anchor)), 0, LENGTH - GRAM)]
    while todo:
        own, low, high = todo.pop()
        own = own[(left[own] >= low) & (right[own] >= LENGTH - high)]
        if len(own) > most:
            before, after = np.minimum(left[own], high), np.minimum(right[own], LENGTH - low)
            first = _first(octets, anchor[own], before, after, age[own])
            again = age[own] > age[own[first]]
            yield True, own[again], before[again], after[again]
            # Nor do others of the same place, as of a repeated row: they are covered alike.
            own = own[first == np.arange(len(own))]
        if len(own) <= most:
            yield False, own, np.minimum(left[own], high), np.minimum(right[own], LENGTH - low)
            continue
        same = np.full(len(own), low), np.full(len(own), LENGTH - high)
        keys = _hashes(octets, anchor[own], *same)
        order = np.argsort(keys, kind="stable")
        own, keys = own[order], keys[order]
        cuts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(own))
        first = 0
        while first < len(cuts) - 1:
            # As many groups as fit, at least one.
            last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + most, "right")) - 1)
            part = own[cuts[first] : cuts[last]]
            if len(part) > most and low < high:
                middle = (low + high) // 2
                todo += [(part, low, middle), (part, middle + 1, high)]
            elif len(part) > 1:
                yield False, part, np.minimum(left[part], high), np.minimum(right[part], LENGTH - low)
            first = last


def _rows(octets: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Bytes from ``begin`` on, ``size`` of them and zeros up to ``width``."""
    at = np.arange(width)
    rows = octets[np.minimum(begin[:, None] + at, len(octets) - 1)]
    return np.where(at < size[:, None], rows, np.uint8(0))


def _hashes(octets: np.ndarray, anchor: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of the bytes around anchors, that many before and after."""
    size = before + after
    width = -(-int(size.max(initial=0)) // 8) * 8
    out = np.empty(len(anchor), dtype=_U)
    for at in range(0, len(anchor), _ROWS):
        cut = slice(at, at + _ROWS)
        total = _mix((before[cut] << 8 | after[cut]).astype(_U))
        for word in _rows(octets, (anchor - before)[cut], size[cut], width).view(_U).T:
            total = _mix((total ^ word) * _BASE)
        out[cut] = total
    return out


def _first(
    octets: np.ndarray, anchor: np.ndarray, before: np.ndarray, after: np.ndarray, age: np.ndarray
) -> np.ndarray:
    """Of each context, the earliest that is equal; what has equal hashes is compared."""
    keys = _hashes(octets, anchor, before, after)
    order = np.lexsort((age, keys))
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    first = np.empty(len(keys), dtype=np.int64)
    first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
    size = before + after
    for at in range(0, len(first), _ROWS):
        own = np.arange(at, min(at + _ROWS, len(first)))
        to = first[own]
        width = int(size[own].max())
        a, b = (_rows(octets, (anchor - before)[x], size[x], width) for x in (own, to))
        equal = (a == b).all(axis=1) & (before[own] == before[to]) & (after[own] == after[to])
        first[own] = np.where(equal, to, own)
    return first


def _union(ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans with overlapping or touching ones of a document put together."""
    if not len(ids):
        return ids, begin, end
    order = np.lexsort((begin, ids))
    ids, begin, end = ids[order], begin[order], end[order]
    new_id = np.append(True, ids[1:] != ids[:-1])
    group = np.cumsum(new_id) - 1
    # Ends as numbers that grow from document to document, for a running maximum.
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * step) - group * step
    new = new_id | np.append(True, begin[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return ids[first], begin[first], np.maximum.reduceat(reach, first)


# --- 4. cutting ---

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, max(1, b.num_rows), 1000)):
        rows = []
        for doc_id, text, spans in zip(
            batch.column(0).to_pylist(), _octets(batch, 1), batch.column(2).to_pylist(), strict=True
        ):
            found = np.array([(x["start"], x["end"]) for x in spans or ()], dtype=np.int64).reshape(-1, 2)
            _, begin, end = _union(np.zeros(len(found), np.int64), found[:, 0], found[:, 1])
            edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((doc_id, len(text), len(text) - len(kept), len(begin), kept))
        kinds = [*[pa.int64()] * 4, pa.binary()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def repeated_spans(base: DataFrame) -> DataFrame:
    """``(doc_id, start, end)``: bytes of ``(doc_id, text)`` that a string starting earlier has."""
    # Several for each reducer, so that a bucket's texts, sorted at once, are few.
    buckets = 1 << max(4, partitions(base.sparkSession).bit_length() + 2)
    flagged = store(
        base.mapInArrow(_send(buckets), _SENT)
        .groupBy("bucket")
        .applyInArrow(_match, "batch long, again binary, ids binary, sizes binary")
        .groupBy("batch")
        .applyInArrow(_gather, "doc_id long, numbers binary"),
        "suffix-anchors",
    )
    wanted = flagged.withColumnRenamed("doc_id", "__id")
    near = base.filter(may_be_in(flagged, "doc_id")(F.col("doc_id")))
    contexts = near.join(wanted, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "numbers")
    return (
        contexts.mapInArrow(_pack(buckets.bit_length() - 1), _PACKED)
        .groupBy("bucket", "salt")
        .applyInArrow(_cover, _SPANS)
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every document.

    Texts are UTF-8 bytes, NULL an empty one. Each byte covered by a 100-byte string that also
    starts earlier (in a smaller id, or earlier in the same document) is removed, judged on the
    input; ``n_spans`` counts maximal removed runs and ``kept`` is what is left, which may cut
    characters. Rows that repeat an id and text are one document and don't cover each other;
    each gives a row. Ids that are NULL count as the smallest, in an order of their texts'
    hashes; other ids must be at least -2**62. Texts that differ should not share an id: they
    are cut alike. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    unnamed = F.lit(-(1 << 63)) + F.xxhash64(text).bitwiseAND((1 << 62) - 1)
    base = docs.select(
        F.coalesce(F.col(id_col).cast("long"), unnamed).alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    text = F.coalesce("text", F.lit(""))
    digests = store(
        base.select(
            "doc_id",
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        ),
        "suffix-digests",
    )
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = store(
        attach(digests.filter(f"n_bytes >= {LENGTH}"), first, ["digest"])
        .filter("doc_id <> first")
        .select("doc_id", "n_bytes"),
        "suffix-copies",
    )
    doubtful = may_be_in(copies, "doc_id")(F.col("doc_id"))
    gone = copies.select(F.col("doc_id").alias("__id")).distinct()
    single = base.filter(~doubtful).unionByName(
        base.filter(doubtful).join(gone, F.col("doc_id") == F.col("__id"), "left_anti")
    )
    with small_batches(docs.sparkSession):
        spans = store(repeated_spans(single), "suffix-spans")
    listed = spans.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    hit = may_be_in(spans, "doc_id")(F.col("doc_id"))
    no_spans = F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    cut = (
        single.filter(hit)
        .join(listed, F.col("doc_id") == F.col("__id"), "left")
        .select("doc_id", "text", "spans")
        .unionByName(single.filter(~hit).select("doc_id", "text", no_spans.alias("spans")))
        .mapInArrow(_cut, _RESULT)
    )
    copied = copies.select(
        "doc_id",
        "n_bytes",
        F.col("n_bytes").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.lit(b"").alias("kept"),
    )
    return cut.unionByName(copied).withColumn(
        "doc_id", F.when(F.col("doc_id") >= -(1 << 62), F.col("doc_id"))
    )


def op5_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
