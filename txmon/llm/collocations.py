"""Phrase collocations, counted in quotient filters.

1. Tasks cut their texts into blocks of one language and write each as numbers of its own
   dictionary. Adding up the dictionaries gives exact word counts; the words that occur often
   enough to be in a candidate get the numbers 1, 2, 3 ... of the whole corpus.
2. A block's part of that dictionary is joined back to it. Its n-grams are packed word numbers,
   mixed by an invertible permutation. The upper bits (the quotient) say which region of the
   key space an n-gram belongs to and its place there, the rest is the remainder. A region's
   filter holds the sorted remainders, a bitmap from which the quotients follow, and counters:
   nothing is lost, the words come back by the inverse permutation.
3. Sorted filters of a region are merged across blocks. Regions hold about half a million n-grams;
   as the permutation spreads them, none is hot. A block that would fall into more regions
   than its filters are worth is merged with others first, in rounds.
4. Frequent n-grams are scored with Spark joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import UPPER, documents, store
from txmon.operators.joins import attach

MIN_COUNT = 10
TOP = 2000
COVER_PERCENT = 50
# Piece ends: . , ; : ! ? and 0x0A to 0x0D.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

_BLOCK_BYTES = 1 << 22
# Most n-grams of a region, on average: half a million.
_REGION = 1 << 19
# Bits that number the regions a single block is cut into, at most: finer, its filters would be
# too small to be worth sending. A round merges so many shards and cuts as many times finer.
_BLOCK_TOP = 10
_FAN_IN_BITS = 6

_FOLD = bytes.maketrans(
    UPPER.encode() + b"\t" + PIECE_ENDS, UPPER.lower().encode() + b" " + b"\n" * len(PIECE_ENDS)
)
_BLOCKS = "block long, lang string, tokens long, codes binary, words array<binary>, counts array<long>"
_FILTERS = "region long, shard long, n long, bitmap binary, low binary, third binary, small binary, large binary"
_GRAMS = "id1 long, id2 long, id3 long, a long"

_U = np.uint64


# --- 1. blocks and their dictionaries ---


def _encoded(block: int, lang: str, texts: list[bytes]) -> dict:
    """A block: word numbers in order (0 ends a piece), and its dictionary with counts."""
    folded = b"\n".join(texts).translate(_FOLD).replace(b"\n", b" \n ")
    parts = pc.split_pattern(pa.array([folded], pa.binary()), pattern=b" ").values
    found = parts.dictionary_encode()
    words, codes = found.dictionary, found.indices.to_numpy().astype(np.int64)
    end, none = words.index(b"\n").as_py(), words.index(b"").as_py()
    number = np.zeros(len(words), dtype=np.int32)
    own = np.setdiff1d(np.arange(len(words)), [end, none])
    number[own] = np.arange(1, len(own) + 1)
    if none >= 0:
        codes = codes[codes != none]
    local = number[codes]
    counts = np.bincount(local, minlength=len(own) + 1)[1:]
    return {
        "block": block,
        "lang": lang,
        "tokens": int(counts.sum()),
        "codes": local.tobytes(),
        "words": words.take(pa.array(own)),
        "counts": counts,
    }


def _blocks(limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_texts: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        task = TaskContext.get().partitionId() << 32
        done = 0

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal done
            row = _encoded(task + done, lang, open_texts.pop(lang))
            del sizes[lang]
            done += 1
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
            names = ("block", "lang", "tokens", "codes")
            plain = [pa.array([row[n]], k) for n, k in zip(names, kinds, strict=True)]
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                for v in (row["words"], pa.array(row["counts"], pa.int64()))
            ]
            return pa.RecordBatch.from_arrays([*plain, *lists], [*names, "words", "counts"])

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                data = text.as_py()
                open_texts.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data) + 1
                # Both the block of one language and what is open in all are bounded.
                if sizes[lang] >= limit:
                    yield flush(lang)
                elif len(sizes) > 1 and sum(sizes.values()) >= 4 * limit:
                    yield flush(max(sizes, key=sizes.__getitem__))
        for lang in list(open_texts):
            yield flush(lang)

    return run


def _dictionary(blocks: DataFrame, min_count: int) -> DataFrame:
    """``(id, lang, word, f)`` of the words that occur ``min_count`` times, ids from 1 on."""
    counted = (
        blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
        .groupBy("lang", F.col("x.words").alias("word"))
        .agg(F.sum("x.counts").alias("f"))
        .filter(F.col("f") >= min_count)
    )
    # Numbered by partition and place in it, once and for all as they are stored.
    place = F.monotonically_increasing_id()
    stored = store(counted.withColumn("place", place), "phrase-words")
    part = F.shiftright("place", 33)
    # One row for each partition that wrote words.
    parts = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = parts.select("part", before.alias("before"))
    inside = F.col("place").bitwiseAND((1 << 33) - 1)
    return (
        stored.withColumn("part", part)
        .join(offsets, "part")
        .select((F.col("before") + inside + 1).alias("id"), "lang", "word", "f")
    )


# --- 2. quotient filters ---


class Packing:
    """Three word numbers of ``bits`` each as a permuted pair (first two words mixed, third).

    The pair of the first two has ``2 * bits`` bits; the third is mixed into it, so that
    n-grams with a frequent beginning are spread, too. A bigram's third number is 0.
    """

    def __init__(self, bits: int) -> None:
        if not 1 <= bits <= 31:
            raise ValueError("between 1 and 2**31 - 1 words")
        self.bits, self.width = bits, 2 * bits
        self._mask = _U((1 << self.width) - 1)
        self._half = _U((self.width + 1) // 2)
        odd = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
        self._odd = [_U(x & ((1 << self.width) - 1)) for x in odd]
        self._back = [_U(pow(x, -1, 1 << self.width)) for x in odd]

    def _spread(self, third: np.ndarray) -> np.ndarray:
        x = (third * self._odd[2]) & self._mask
        return x ^ (x >> self._half)

    def pack(self, ids: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        first, second, third = (x.astype(_U) for x in ids)
        x = ((first << _U(self.bits)) | second) ^ self._spread(third)
        for odd in self._odd[:2]:
            x ^= x >> self._half
            x = (x * odd) & self._mask
        return x ^ (x >> self._half), third

    def unpack(self, mixed: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, ...]:
        x = mixed ^ (mixed >> self._half)
        for back in self._back[1::-1]:
            x = (x * back) & self._mask
            x ^= x >> self._half
        x ^= self._spread(third)
        low = _U((1 << self.bits) - 1)
        return tuple(part.astype(np.int64) for part in (x >> _U(self.bits), x & low, third))

    def added_up(
        self, mixed: np.ndarray, third: np.ndarray, counts: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys, each once, with the sums of their counts."""
        if not len(mixed):
            return mixed, third, np.zeros(0, dtype=np.int64)
        if self.width + self.bits <= 64:
            key = (mixed << _U(self.bits)) | third
            if counts is None:
                key, totals = np.unique(key, return_counts=True)
                return key >> _U(self.bits), key & _U((1 << self.bits) - 1), totals
            order = np.argsort(key, kind="stable")  # merges the sorted runs it finds
            key = key[order]
            new = key[1:] != key[:-1]
        else:
            order = np.lexsort((third, mixed))
            new = (np.diff(mixed[order]) != 0) | (np.diff(third[order]) != 0)
        first = np.flatnonzero(np.append(True, new))
        if counts is None:
            totals = np.diff(np.append(first, len(order)))
        else:
            totals = np.add.reduceat(counts[order], first)
        at = order[first]
        return mixed[at], third[at], totals

    # A filter covers the keys whose upper ``top`` bits are its region.

    def filters(
        self, keys: tuple[np.ndarray, np.ndarray, np.ndarray], top: int, shard: int
    ) -> Iterator[dict]:
        """Sorted keys as one filter for each region that has any."""
        mixed, third, counts = keys
        rest = self.width - top
        regions = mixed >> _U(rest) if rest < 64 else np.zeros_like(mixed)
        cuts = np.flatnonzero(np.append(True, regions[1:] != regions[:-1])) if len(mixed) else []
        ends = np.append(cuts, len(mixed))
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            n = hi - lo
            split = min(rest, n.bit_length() - 1)
            inside = mixed[lo:hi] & _U((1 << rest) - 1)
            quotient = (inside >> _U(rest - split)).astype(np.int64)
            # A 1 for each key, after as many 0s as its quotient says.
            bits = np.zeros(n + (1 << split), dtype=np.uint8)
            bits[quotient + np.arange(n)] = 1
            own = counts[lo:hi]
            yield {
                "region": int(regions[lo]),
                "shard": shard,
                "n": n,
                "bitmap": np.packbits(bits).tobytes(),
                "low": _octets(inside & _U((1 << (rest - split)) - 1), rest - split),
                "third": _octets(third[lo:hi], self.bits),
                "small": np.minimum(own, 255).astype(np.uint8).tobytes(),
                "large": own[own >= 255].astype(np.int64).tobytes(),
            }

    def keys(self, row: dict, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What a filter holds, in order."""
        n, rest = row["n"], self.width - top
        split = min(rest, n.bit_length() - 1)
        bits = np.unpackbits(np.frombuffer(row["bitmap"], dtype=np.uint8))
        quotient = (np.flatnonzero(bits)[:n] - np.arange(n)).astype(_U)
        region = _U(row["region"] << rest)
        mixed = region | (quotient << _U(rest - split)) | _numbers(row["low"], n)
        counts = np.frombuffer(row["small"], dtype=np.uint8).astype(np.int64)
        counts[counts == 255] = np.frombuffer(row["large"], dtype=np.int64)
        return mixed, _numbers(row["third"], n), counts


def _octets(numbers: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` bits in as few whole bytes each."""
    octets = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return octets[:, : -(-bits // 8)].tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    if data:
        out[:, : len(data) // n] = np.frombuffer(data, dtype=np.uint8).reshape(n, -1)
    return out.view("<u8").ravel().astype(_U)


def _ngrams(ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bigrams and trigrams of a row of word numbers; nothing goes across a 0."""
    two = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    three = two[:-1][np.diff(two) == 1]
    first = np.concatenate([ids[two], ids[three]])
    second = np.concatenate([ids[two + 1], ids[three + 1]])
    third = np.concatenate([np.zeros(len(two), dtype=ids.dtype), ids[three + 2]])
    return first, second, third


def _table(rows: Iterable[dict]) -> pa.Table:
    names = [part.split(" ") for part in _FILTERS.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.Table.from_pylist(list(rows), pa.schema([(n, kinds[k]) for n, k in names]))


def _count(packing: Packing, top: int):
    """The filters of a block from its numbers and its part of the dictionary."""

    def run(blocks: pa.Table, words: pa.Table) -> pa.Table:
        out: list[dict] = []
        for row in blocks.to_pylist():  # one
            local = np.frombuffer(row["codes"], dtype=np.int32)
            lookup = np.zeros(int(local.max(initial=0)) + 1, dtype=np.int64)
            lookup[words["local"].to_numpy()] = words["id"].to_numpy()
            packed = packing.pack(_ngrams(lookup[local]))
            out.extend(packing.filters(packing.added_up(*packed), top, row["block"]))
        return _table(out)

    return run


def _merged(packing: Packing, top: int, table: pa.Table) -> tuple[np.ndarray, ...]:
    parts = [packing.keys(row, top) for row in table.to_pylist()]
    return packing.added_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _merge(packing: Packing, top: int, finer: int):
    """One filter for a region and group of shards, cut into finer regions."""

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        return _table(packing.filters(_merged(packing, top, table), finer, shard))

    return run


def _frequent(packing: Packing, top: int, min_count: int):
    """The n-grams of a region that occur often enough."""

    def run(table: pa.Table) -> pa.Table:
        mixed, third, counts = _merged(packing, top, table)
        often = counts >= min_count
        ids = packing.unpack(mixed[often], third[often])
        return pa.table(dict(zip(("id1", "id2", "id3", "a"), (*ids, counts[often]), strict=True)))

    return run


def _counted(blocks: DataFrame, words: DataFrame, min_count: int) -> DataFrame:
    """All bigrams and trigrams that occur ``min_count`` times, by word numbers."""
    size, tokens = words.agg(F.max("id"), F.sum("f")).first()
    packing = Packing(max(1, int(size or 0).bit_length()))
    # Every frequent token begins two n-grams at most.
    wanted = min(packing.width, max(0, (2 * int(tokens or 0) // _REGION).bit_length()))
    top = min(wanted, _BLOCK_TOP)
    local = (
        blocks.select("block", "lang", F.posexplode("words").alias("at", "word"))
        .join(words.select("lang", "word", "id"), ["lang", "word"])
        .select(F.col("block").alias("of"), (F.col("at") + 1).cast("long").alias("local"), "id")
    )
    filters = (
        blocks.select("block", "codes")
        .groupBy("block")
        .cogroup(local.groupBy("of"))
        .applyInArrow(_count(packing, top), _FILTERS)
    )
    shards = blocks.count() if top < wanted else 0
    while top < wanted:
        finer = min(wanted, top + _FAN_IN_BITS)
        shards = max(1, -(-shards // (1 << _FAN_IN_BITS)))
        filters = store(
            filters.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(shards)))
            .groupBy("region", "shard")
            .applyInArrow(_merge(packing, top, finer), _FILTERS),
            "phrase-filters",
        )
        top = finer
    return filters.groupBy("region").applyInArrow(
        _frequent(packing, top, min_count), _GRAMS
    )


# --- 4. scores ---


def _scored(grams: DataFrame, words: DataFrame, cover_percent: int) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the candidates that no longer one covers."""

    def word(k: int) -> DataFrame:
        found = words.select(F.col("id").alias(f"id{k}"), F.col("f").alias(f"f{k}"))
        spelt = words.select(F.col("id").alias("__w"), F.col("word").alias(f"w{k}"), "lang")
        both = found.join(spelt, F.col(f"id{k}") == F.col("__w")).drop("__w")
        return both if k == 1 else both.drop("lang")

    two = grams.filter("id3 = 0").drop("id3")
    three = grams.filter("id3 > 0")
    longer = (
        three.select("id1", "id2", "a")
        .union(three.select("id2", "id3", "a"))
        .groupBy("id1", "id2")
        .agg(F.max("a").alias("longest"))
    )
    pairs = (
        attach(two, longer, ["id1", "id2"])
        .filter(f"longest IS NULL OR 100 * longest < {cover_percent} * a")
        .drop("longest")
        .withColumns({"id3": F.lit(None).cast("long"), "head": F.lit(None).cast("long")})
        .withColumn("tail", F.lit(None).cast("long"))
    )
    heads = two.select("id1", "id2", F.col("a").alias("head"))
    tails = two.select(
        F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("a").alias("tail")
    )
    triples = attach(attach(three, heads, ["id1", "id2"]), tails, ["id2", "id3"])
    found = pairs.unionByName(triples)
    for k in (1, 2, 3):
        found = attach(found, word(k), [f"id{k}"])

    def cut(left: str, right: str) -> str:
        big = lambda x: f"cast({x} AS decimal(38,0))"
        product = f"{big('a')} * {big('a')} * 1000000 div ({big(left)} * {big(right)})"
        return f"named_struct('score', {product}, 'l', {left}, 'r', {right})"

    # The struct's order is score, then cut: least() keeps the first of equal scores.
    first = f"CASE WHEN id3 IS NULL THEN {cut('f1', 'f2')} ELSE {cut('f1', 'tail')} END"
    second = f"CASE WHEN id3 IS NOT NULL THEN {cut('head', 'f3')} END"
    return (
        found.withColumns({"one": F.expr(first), "other": F.expr(second)})
        .withColumn("best", F.expr("CASE WHEN other.score < one.score THEN other ELSE one END"))
        .select(
            "lang",
            F.concat_ws(" ", *(F.col(f"w{k}").cast("string") for k in (1, 2, 3))).alias("phrase"),
            "a",
            "best.l",
            "best.r",
            "best.score",
        )
    )


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    cover_percent: int = COVER_PERCENT,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of 2 or 3 words.

    A-Z is lower-cased; pieces end at ``.,;:!?`` and 0x0A to 0x0D, words at space and tab.
    Phrases lie within a piece and occur ``a >= min_count`` times, repeated rows and overlaps
    included. Cut after ``k`` words, the parts occur ``l`` and ``r`` times; the score is
    ``floor(1000000 * a * a / (l * r))`` at the lowest cut, the first of equal ones. A phrase
    inside a longer candidate that has ``cover_percent`` of its occurrences is left out. Ranks
    go by score, count and phrase; ``n`` counts the language's words. A NULL language is
    ``und``, a NULL text is empty; languages without candidates give no rows, nor do no
    documents. Other columns are ignored.
    """
    base = docs.select(
        F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    blocks = store(base.mapInArrow(_blocks(_BLOCK_BYTES), _BLOCKS), "phrase-blocks")
    words = store(_dictionary(blocks, min_count), "phrase-dictionary")
    grams = store(_counted(blocks, words, min_count), "phrase-grams")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # The filter on the rank lets Spark cut each task's rows before it sends them.
    best = _scored(grams, words, cover_percent).withColumn("rank", F.row_number().over(order))
    totals = blocks.groupBy("lang").agg(F.sum("tokens").alias("n"))
    return best.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op13_quotient_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM pieces),
tokens AS (SELECT lang, id, unnest(w) AS w1, unnest(range(len(w))) AS i FROM listed),
follows AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3
  FROM tokens WINDOW o AS (PARTITION BY id ORDER BY i)),
one AS (SELECT lang, w1 AS g, count(*)::HUGEINT AS f FROM follows GROUP BY ALL),
two AS (
  SELECT lang, w1, w2, concat(w1, ' ', w2) AS g, count(*)::HUGEINT AS f
  FROM follows WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (
  SELECT lang, w1, w2, w3, concat(w1, ' ', w2, ' ', w3) AS g, count(*)::HUGEINT AS f
  FROM follows WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM one GROUP BY lang),
halves AS (
  SELECT lang, g, f, 1 AS k, w1 AS head, w2 AS tail FROM two
  UNION ALL SELECT lang, g, f, 1, w1, concat(w2, ' ', w3) FROM three
  UNION ALL SELECT lang, g, f, 2, concat(w1, ' ', w2), w3 FROM three),
counts AS (SELECT lang, g, f FROM one UNION ALL SELECT lang, g, f FROM two),
cuts AS (
  SELECT h.lang, h.g, h.f AS a, k, p.f AS l, q.f AS r, (1000000 * h.f * h.f) // (p.f * q.f) AS score
  FROM halves h
  JOIN counts p ON p.lang = h.lang AND p.g = h.head
  JOIN counts q ON q.lang = h.lang AND q.g = h.tail),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
covering AS (
  SELECT lang, g, max(f) AS f FROM (
    SELECT lang, concat(w1, ' ', w2) AS g, f FROM three
    UNION ALL SELECT lang, concat(w2, ' ', w3), f FROM three) GROUP BY lang, g),
ranked AS (
  SELECT s.lang, s.g AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.g) AS rank
  FROM scored s LEFT JOIN covering c ON c.lang = s.lang AND c.g = s.g
  WHERE c.f IS NULL OR 100 * c.f < 50 * s.a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
