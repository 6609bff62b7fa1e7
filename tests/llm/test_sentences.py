"""Sentences go by document, which is an id with a text; expected texts, not counts."""

from __future__ import annotations

from txmon.llm.sentence_spans import remove_repeated_sentences

SHARED = "The first one here. The second one here. The third one here. "


def left(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = remove_repeated_sentences(table).select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in found if r.doc_id is not None), sorted(
        r.text for r in found if r.doc_id is None
    )


def test_texts_that_share_an_id(spark):
    own = "Own one. Own two. Own three. Own four."
    rows = [(1, SHARED), (5, SHARED + "More of it."), (5, own), (5, None)]
    named, _ = left(spark, rows)
    assert named == sorted([(1, SHARED), (5, "More of it."), (5, own), (5, "")])


def test_texts_without_an_id(spark):
    own = "Own one. Own two. Own three. Own four."
    rows = [(None, own), (None, "X. " + SHARED), (None, SHARED + "Y."), (3, SHARED + "Z."), (None, "")]
    named, unnamed = left(spark, rows)
    # NULL is the smallest id; of two texts without one, either may be first.
    assert named == [(3, "Z.")]
    assert unnamed in (
        sorted([own, "", "X. " + SHARED, "Y."]), sorted([own, "", "X. ", SHARED + "Y."])
    )


def test_repeated_rows_are_one_document(spark):
    named, _ = left(spark, [(1, SHARED), (1, SHARED), (2, SHARED + "End.")])
    assert named == [(1, SHARED), (1, SHARED), (2, "End.")]


def test_a_repeat_inside_a_document(spark):
    named, _ = left(spark, [(1, SHARED + "Between. " + SHARED + "End.")])
    assert named == [(1, SHARED + "Between. End.")]
