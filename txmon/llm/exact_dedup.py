"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import ascii_lower, documents, only_ids, store
from txmon.operators.joins import attach

PREFIX_CHARS = 256


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept)`` for every document, dropped ones too.

    Texts are equal when identical after lower-casing A-Z; a NULL text counts as empty.
    Of equal texts the largest id stays (an id that is NULL only if it has no rival).
    Lengths and prefix hashes are grouped over narrow rows; whole texts are read again only
    where a length and a prefix hash occur twice. Rows that repeat both id and text are one
    document and come back as one row. Other columns of ``docs`` are ignored.
    """
    base = _base(docs, id_col, text_col)
    narrow, suspects = _suspects(base)
    hashed = store(
        only_ids(base, "doc_id", suspects, "doc_id")
        .select("doc_id", F.unhex(F.sha2(ascii_lower(F.col("text")), 256)).alias("full"))
        .distinct(),
        "exact-hashed",
    )
    groups = hashed.groupBy("full").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    decided = attach(hashed, groups, ["full"]).select("doc_id", "keep_id", "group_size")
    alone = narrow.join(
        suspects.withColumnRenamed("doc_id", "__id"),
        F.col("doc_id").eqNullSafe(F.col("__id")),
        "left_anti",
    ).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return decided.unionByName(alone).withColumn("kept", same)


def equal_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, own, root)`` of every row whose text may be another's: equal texts share ``root``.

    ``own`` is the MD5 digest of the text. Found as in :func:`exact_duplicates`, but by row.
    """
    base = _base(docs, id_col, text_col)
    return only_ids(base, "doc_id", _suspects(base)[1], "doc_id").select(
        "doc_id",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("own"),
        F.unhex(F.sha2(ascii_lower(F.col("text")), 256)).alias("root"),
    )


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def _suspects(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lengths and prefix hashes of all rows, and the ids where both occur twice."""
    prefix = ascii_lower(F.substring("text", 1, PREFIX_CHARS))
    narrow = store(
        base.select(
            "doc_id",
            F.octet_length("text").alias("n_bytes"),
            F.xxhash64(prefix).alias("prefix"),
        ),
        "exact-narrow",
    )

    suspects = _shared(_shared(narrow, ["n_bytes"]), ["n_bytes", "prefix"])
    return narrow, store(suspects.select("doc_id").distinct(), "exact-suspects")


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys occur more than once."""
    often = rows.groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1")
    return attach(rows, often, keys).filter("__n IS NOT NULL").drop("__n")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    text = ascii_lower(F.coalesce("text", F.lit("")))
    digests = docs.select(
        F.col("doc_id").alias("__id"), F.unhex(F.sha2(text, 256)).alias("__digest")
    )
    found = exact_duplicates(docs)
    return found.join(digests, F.col("doc_id").eqNullSafe(F.col("__id")), "left").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("__digest")).alias("text_sha256")
    )


OP8_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""
