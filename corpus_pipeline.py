"""A training corpus from ``documents``: rules, exact and near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm import exact_dedup, jaccard, packing, pii, quality
from txmon.llm.common import discard, may_be_in, ship_code, store
from txmon.operators.joins import attach

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without the lines that failed.

    A NULL or empty text has too few words and goes. Repeated rows and rows without an id are
    judged one by one. Other columns than those of ``documents`` are dropped; no rows give none.
    """
    judged = quality.line_first(docs, carry=("lang", "source")).filter("kept")
    return judged.select(
        "doc_id",
        F.col("clean_text").alias("text"),
        "lang",
        "source",
        F.length("clean_text").cast("long").alias("n_chars"),
    )


def _one_each(docs: DataFrame, rows: DataFrame, largest: bool) -> DataFrame:
    """Of rows ``(doc_id, own, root)`` with equal ``root`` one, all other documents; few texts move.

    Rows are told apart by id and text digest. The largest or smallest id stays, one that is
    NULL only without a rival; of rows that repeat id and text one stays.
    """
    rows = store(rows, "linked-rows")
    # A NULL id is last in the order.
    order = F.struct(
        (F.col("doc_id").isNotNull() if largest else F.col("doc_id").isNull()).alias("rank"),
        "doc_id",
        "own",
    )
    best = F.max(order) if largest else F.min(order)
    groups = rows.groupBy("root").agg(best.alias("best"), F.count("*").alias("n")).filter("n > 1")
    gone = store(
        attach(rows, groups, ["root"])
        .filter("best IS NOT NULL")
        .select(
            F.col("doc_id").alias("__id"),
            F.col("own").alias("__own"),
            (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("own") == F.col("best.own"))).alias("__stays"),
        )
        .distinct(),
        "dropped",
    )
    doubtful = may_be_in(gone, "__id")(F.col("doc_id"))
    own = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    checked = docs.filter(doubtful).select(*COLUMNS, own.alias("__text"))
    judged = checked.join(
        gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__own")), "left"
    )
    return (
        docs.filter(~doubtful)
        .select(*COLUMNS)
        .unionByName(judged.filter("__stays IS NULL").select(*COLUMNS))
        .unionByName(judged.filter("__stays").dropDuplicates(["doc_id", "__text"]).select(*COLUMNS))
    )


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id.

    A NULL text equals an empty one. Rows are judged by id and text: one of those that repeat
    both stays, a text whose id another text has is judged by itself, and a row without an
    id stays only if no equal text has one. No rows give none.
    """
    ship_code(spark)
    return _one_each(docs, exact_dedup.equal_rows(docs), largest=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id.

    Linked are texts, directly or through others; a NULL, empty or blank one is linked to
    nothing, not even its like, and stays. Rows that repeat an id and a linked text become one;
    rows without an id stay only if no linked text has one. No rows give none.
    """
    ship_code(spark)
    return _one_each(docs, jaccard.linked_rows(docs), largest=False)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind in brackets in place of each personal span.

    A row stays a row, repeated ones and those without an id, too; a NULL text stays NULL. The
    classifier is trained on the votes of all rows; without any span it is not needed.
    """
    model = pii.train(store(pii.vote_counts(docs), "pii-votes"))
    clean = docs.select(
        "doc_id",
        pii.masked(F.col("text"), pii.found_spans(F.col("text"), model)).alias("text"),
        "lang",
        "source",
    )
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces of binary length with their ids.

    Every row is packed, repeated ones and those without an id, too; a NULL or empty text is
    one piece with the end's id. No rows give no sequences.
    """
    import public_tokenizers

    ship_code(spark)
    return packing.power_of_two(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("packing", packed),
]

# Near copies, the span classifier and the tokens have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder until the next is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, f"stage-{i + 1}")
            discard(before)
    return docs
