"""Mixing sources to target weights by weighted fair queueing.

1. Words are counted once; from then on there are only narrow rows. Rows that agree in id,
   source and size are interchangeable and travel as one with a number of copies.
2. Targets fill up like water: sources at their limit drop out and the others share again.
   Each round is one sum over a table of sources, so the driver sees two numbers a round.
3. Each source is a queue in random order (by digest), passed twice at most. A document's
   virtual finish time is its source's words up to its end, divided by the target. Queues are
   summed in buckets of digests, whose totals are added up first, so no task holds a source.
4. All queues are ordered by finish time: equal slices of virtual time hold nearly equal
   numbers of words, whatever the sources, which is what fair queueing is for. Slice totals
   give each slice its start, a window inside the slice the rest. The sequence ends where the
   budget is used up, at virtual time 1; a document in service then is cut there, so every
   source gets its target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import documents, store
from txmon.operators.joins import attach

# By source in code point order, repeating.
WEIGHTS = (3, 1, 2)
# The mix has this share of all words, a source at most so many times its own.
BUDGET_PERCENT = 150
PASSES = 2

# Rows of a bucket or slice, on average at most.
_ROWS = 1 << 14
_WORD = "[^ \\t-\\r]+"


def sized(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``(doc_id, source, size, copies)``; size is the number of words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"),
        )
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("copies"))
    )


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, from 0 on, NULL last.

    Sorted by range over all tasks; the places before a range come from the ranges' counts.
    """
    last = F.col("source").isNull()
    parts = sources.repartitionByRange(last, "source").withColumn("part", F.spark_partition_id())
    stored = store(parts, "mix-sources")
    counts = stored.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(last, "source")
    return (
        stored.join(offsets, "part")
        .withColumn("number", F.col("before") + F.row_number().over(inside) - 1)
        .drop("part", "before")
    )


def targets(
    sources: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    passes: int = PASSES,
) -> DataFrame:
    """``(number, source, source_size, weight, target)`` of each ``(source, source_size)``."""
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("number") % len(weights)).cast("int"))
    table = store(
        _numbered(sources).withColumns(
            {"weight": weight.cast("long"), "most": F.col("source_size") * passes}
        ),
        "mix-weights",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget = budget_percent * total / 100

    # A source is at its limit when its share of what the others leave reaches it.
    full, full_words, open_weight = F.lit(False), 0, 0
    while True:
        words, weighing = table.agg(
            F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        words, weighing = words or 0, weighing or 0
        if (words, weighing) == (full_words, open_weight):
            break
        full_words, open_weight = words, weighing
        full = F.col("most") <= _share(budget, words, weighing) if weighing else F.lit(True)
    share = _share(budget, full_words, open_weight) if open_weight else F.lit(0.0)
    target = F.when(full, F.col("most").cast("double")).otherwise(share)
    return table.withColumn("target", target).drop("most")


def _share(budget: float, full_words: int, open_weight: int) -> Column:
    left = F.lit(float(budget)) - F.lit(float(full_words))
    return left * F.col("weight").cast("double") / F.lit(float(open_weight))


def _power(rows: int) -> int:
    """Bits that number enough buckets for ``rows``."""
    return min(48, (rows // _ROWS).bit_length())


def _running(rows: DataFrame, keys: list[str], bucket: str, words: str, order: list) -> DataFrame:
    """``rows`` with ``before``: the words in front of each, over buckets in their order.

    Buckets are summed first; windows run over one bucket, and over the totals of a key.
    """
    sums = rows.groupBy(*keys, bucket).agg(F.sum(words).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    inside = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = rows.withColumn("__upto", F.sum(words).over(inside) - F.col(words))
    return attach(own, starts.drop("__sum"), [*keys, bucket]).withColumn(
        "before", F.col("__start") + F.col("__upto")
    ).drop("__start", "__upto")


def fair_queue(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    passes: int = PASSES,
    seed: int = 0,
    **columns: str,
) -> tuple[DataFrame, DataFrame]:
    """The mix, and all documents with their shares.

    The mix is ``(doc_id, copy, source, number, size, pass, words, finish, position)``: the
    first ``words`` words of a document come after ``position`` others. The documents are
    ``(doc_id, copy, source, number, size, source_size, target)``, a row for each of ``docs``;
    ``number`` and ``copy`` tell sources and equal rows apart. A NULL text is empty, NULL is a
    source of its own, ids may be NULL or repeat. Documents and sources without words are
    never in the mix and have no target. The order depends on ids, sizes and ``seed`` only.
    Other columns are ignored; no documents give no rows.
    """
    narrow = store(sized(docs, **columns), "mix-sizes")
    sources = narrow.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    aims = store(targets(sources, weights, budget_percent, passes), "mix-targets")
    rows, words = (x or 0 for x in narrow.agg(F.sum("copies"), F.sum("size")).first())

    known = attach(narrow, aims, ["source"], match_unknown=True)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    listed = known.select("doc_id", copy, "source", "number", "size", "source_size", "target")
    digest = F.md5(
        F.concat_ws(
            " ", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size", "copy"
        )
    )
    bits = _power(rows)
    queued = listed.withColumn("digest", digest).withColumn(
        "bucket", F.shiftright(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long"), 48 - bits)
    )
    order = ["digest", F.col("doc_id").asc_nulls_first(), "copy"]
    served = store(_running(queued, ["number"], "bucket", "size", order).drop("bucket"), "mix-queues")

    quota = F.floor("target").cast("long")
    each = F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass")
    begin = F.col("before") + F.col("pass") * F.col("source_size")
    taken = F.least(F.col("size"), quota - begin)
    items = (
        served.filter(F.col("size") > 0)
        .select("*", each)
        .withColumns({"begin": begin, "words": taken})
        .filter("words > 0")
        .withColumn("finish", (F.col("begin") + F.col("words")) / F.col("target"))
        .drop("begin", "before")
    )
    slices = 1 << _power(passes * rows)
    placed = items.withColumns(
        {
            # A whole source is never in one slice, as its words spread over the time.
            "slice": F.least(F.floor(F.col("finish") * slices), F.lit(slices - 1)),
            "all": F.lit(0),
        }
    )
    inside = ["finish", "number", "pass", *order]
    mix = _running(placed, ["all"], "slice", "words", inside).withColumnRenamed("before", "position")
    return mix.drop("all", "slice", "digest", "target", "source_size"), served.drop("digest", "before")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, position)`` for every row of ``docs``.

    ``taken`` is what the mix takes of a document over all passes, ``position`` the words in
    front of its first use (NULL where it has none). See :func:`fair_queue`.
    """
    mix, listed = fair_queue(docs, **options)
    # Copies have numbers; a NULL id is a value like others here.
    key = ["doc_id", "number", "size", "copy"]
    used = mix.groupBy(*key).agg(
        F.sum("words").alias("taken"), F.min("position").alias("position")
    )
    return attach(listed, used, key, match_unknown=True).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "position",
    )


def op12_fair_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir))


OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3 + 1] AS w
  FROM docs GROUP BY source),
filling AS (  -- limits in the order in which rising water reaches them
  SELECT *, 2 * source_size AS most,
         coalesce(sum(2 * source_size) OVER o, 0) AS full_words,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS open_weight,
         sum(source_size) OVER () AS total
  FROM sources
  WINDOW o AS (ORDER BY 2 * source_size / w::DOUBLE, encode(source) NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT full_words, open_weight FROM filling
  WHERE most * open_weight > (1.5::DOUBLE * total - full_words) * w
  ORDER BY full_words LIMIT 1),
aims AS (
  SELECT f.source, source_size,
         CASE WHEN l.open_weight IS NULL OR most <= share THEN most::DOUBLE ELSE share END AS target
  FROM (
    SELECT f.*, l.open_weight AS o,
           (150 * total / 100.0::DOUBLE - l.full_words) * w / l.open_weight AS share
    FROM filling f LEFT JOIN level l ON true) f
  LEFT JOIN level l ON true),
queued AS (
  SELECT d.*, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id NULLS FIRST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (
    SELECT *, md5(concat('0 ', coalesce(doc_id::VARCHAR, '-'), ' ', size, ' ',
      row_number() OVER (PARTITION BY doc_id, source, size) - 1)) AS digest
    FROM docs) d
  JOIN aims a ON a.source IS NOT DISTINCT FROM d.source),
items AS (
  SELECT *, row_number() OVER () AS id FROM queued),
served AS (
  SELECT id, digest, doc_id, source, pass, least(size, floor(target) - before - pass * source_size) AS words,
         (before + pass * source_size + words) / target AS finish
  FROM items, (VALUES (0), (1)) AS passes(pass)
  WHERE size > 0 AND least(size, floor(target) - before - pass * source_size) > 0),
mix AS (
  SELECT id, words, coalesce(sum(words) OVER (
    ORDER BY finish, encode(source) NULLS LAST, pass, digest, doc_id NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
  FROM served),
used AS (SELECT id, sum(words) AS taken, min(position) AS position FROM mix GROUP BY id)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       coalesce(taken, 0)::BIGINT AS taken, position::BIGINT AS position
FROM items LEFT JOIN used USING (id)
"""
