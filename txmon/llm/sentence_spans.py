"""Substring deduplication by sliding runs of sentences, joined over all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import WORD_SPACE, documents, let, may_be_in, store
from txmon.operators.joins import attach

SPAN = 3
# A sentence with what follows it: up to a mark and white space, a line's end, or the end. From
# 120 characters on a comma ends it too, so that passages of few long sentences have runs.
_END = "[.!?…][\"'”’»)\\]]*[ \\t-\\r]+|\\n[ \\t-\\r]*|\\z"
_SENTENCE = f"(?s)(.{{1,119}}?(?:{_END})|.{{119,}}?(?:{_END}|,[ \\t-\\r]+))"


def sentences(text: Column) -> Column:
    """The sentences of a text, separators included: joined they are the text."""
    return F.regexp_extract_all(text, F.lit(_SENTENCE), F.lit(1))


def _runs(units: Column, span: int) -> Column:
    """128-bit hashes of every run of ``span`` sentences, white space around each ignored."""
    clean = F.transform(units, lambda s: F.trim(s, F.lit(WORD_SPACE)))

    def hashed(own: Column) -> Column:
        def run(first: Column, i: Column) -> Column:
            parts = [first, *(F.get(own, i + k) for k in range(1, span))]
            return F.struct(
                F.xxhash64(*parts).alias("h"), F.xxhash64(F.lit(1), *parts).alias("g")
            )

        many = F.greatest(F.size(own) - (span - 1), F.lit(0))
        return F.transform(F.slice(own, 1, many), run)

    return let(clean, hashed)


def repeated_sentences(
    docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, own, positions)``: the sentences to remove, from 0 on, of documents with any.

    A run of ``span`` consecutive sentences that occurs more than once, anywhere, stays where
    it is first (smallest id, then place); the sentences of its other occurrences go. Texts
    with fewer sentences, empty and NULL ones have no runs; rows with a NULL id count as the
    smallest. A document is an id with a text, whose hash is ``own``: texts that share an id,
    or have none, are told apart (in the order of ``own``), while rows that repeat both are one
    document and lose nothing to each other. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("own"),
        _runs(sentences(text), span).alias("runs"),
    ).select("doc_id", "own", F.posexplode("runs").alias("pos", "run"))
    runs = found.select("doc_id", "own", "pos", F.col("run.h").alias("h"), F.col("run.g").alias("g"))
    place = F.struct("doc_id", "own", "pos")
    firsts = (
        runs.groupBy("h", "g")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("h", "g", "first")
    )
    later = attach(runs, firsts, ["h", "g"]).filter(
        F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first"))
    )
    covered = later.groupBy("doc_id", "own").agg(F.collect_set("pos").alias("starts"))
    reach = F.sequence(F.lit(0), F.lit(span - 1))
    positions = F.flatten(F.transform("starts", lambda p: F.transform(reach, lambda k: p + k)))
    sorted_once = F.sort_array(F.array_distinct(positions))
    return covered.select("doc_id", "own", sorted_once.alias("positions"))


def _keep(units: Column, positions: Column) -> Column:
    """The text without the sentences at sorted ``positions``: what lies between them."""
    bounds = F.concat(F.array(F.lit(-1)), positions, F.array(F.size(units)))

    def between(edges: Column) -> Column:
        return F.transform(
            F.slice(edges, 1, F.size(edges) - 1),
            lambda p, i: F.array_join(
                F.slice(units, p + 2, F.greatest(F.get(edges, i + 1) - p - 1, F.lit(0))), ""
            ),
        )

    return F.array_join(let(bounds, between), "")


def remove_repeated_sentences(
    docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_sentences, n_removed, n_spans, text)`` for every document.

    ``n_spans`` counts maximal runs of removed sentences; ``text`` is what is left. See
    :func:`repeated_sentences` for which sentences go and for odd rows.
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    found = store(repeated_sentences(base, span), "repeated-sentences")
    touched = may_be_in(found, "doc_id")(F.col("doc_id"))
    removed = found.select(F.col("doc_id").alias("__id"), F.col("own").alias("__own"), "positions")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__own"))
    cut = (
        base.filter(touched)
        .join(removed, same, "left")
        .select("doc_id", _cut(F.col("text"), F.col("positions")).alias("made"))
        .select("doc_id", "made.*")
    )
    none = F.lit(0).cast("long")
    whole = base.filter(~touched).select(
        "doc_id",
        F.size(sentences(F.col("text"))).cast("long").alias("n_sentences"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        "text",
    )
    return cut.unionByName(whole)


def _cut(text: Column, positions: Column) -> Column:
    """Counts and the text that is left without the sentences at ``positions``."""

    def made(units: Column) -> Column:
        known = F.coalesce(positions, F.array().cast("array<int>"))
        return let(
            F.filter(known, lambda p: p < F.size(units)),
            lambda own: F.struct(
                F.size(units).cast("long").alias("n_sentences"),
                F.size(own).cast("long").alias("n_removed"),
                F.size(F.filter(own, lambda p, i: (i == 0) | (F.get(own, i - 1) != p - 1)))
                .cast("long")
                .alias("n_spans"),
                _keep(units, own).alias("text"),
            ),
        )

    return let(sentences(text), made)


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_sentences(documents(spark, sf_dir)).select(
        "doc_id",
        "n_sentences",
        "n_removed",
        "n_spans",
        F.sha2("text", 256).alias("kept_sha256"),
    )


OP4_SQL = """
WITH s AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''),
    '(?s)(.{1,119}?(?:[.!?…]["''”’»)\\]]*[ \\t-\\r]+|\\n[ \\t-\\r]*|\\z)' ||
    '|.{119,}?(?:[.!?…]["''”’»)\\]]*[ \\t-\\r]+|\\n[ \\t-\\r]*|\\z|,[ \\t-\\r]+))', 1) AS u
  FROM documents),
r AS (
  SELECT doc_id, i, [trim(u[i], w), trim(u[i + 1], w), trim(u[i + 2], w)] AS run
  FROM (SELECT doc_id, u, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS w,
               unnest(range(1, len(u) - 1)) AS i FROM s)),
n AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS nth FROM r),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM n, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
p AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (starts) AS n_spans, list(i) AS gone
  FROM (SELECT doc_id, i,
               coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) <> i - 1, true) AS starts
        FROM c)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n_sentences, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(list_aggregate(list_filter(u, lambda x, j: NOT
         coalesce(list_contains(gone, j), false)), 'string_agg', ''), '')) AS kept_sha256
FROM s LEFT JOIN p USING (doc_id)
"""
