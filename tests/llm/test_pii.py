"""Long personal data is found whole, and nothing of it is left when it is masked."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from txmon.llm import pii

KEY = "aB3" * 106 + "xy"  # 320 characters
LOCAL = "long.name" * 12
CASES = {
    "password": (f"The password={KEY} is ours.", "secret"),
    "prefixed key": (f"Use sk-{KEY} here.", "secret"),
    "written-out address": (f"Write to {LOCAL} [at] {'host' * 30} [dot] {'part' * 20} today.", "email"),
    "many parts": ("Write to jo [at] a" + " [dot] b" * 14 + " today.", "email"),
}


@pytest.mark.parametrize("case", CASES)
def test_no_cap_on_length(spark, case):
    text, kind = CASES[case]
    # A model that accepts every candidate.
    weights = np.zeros(1 + len(pii.LABELERS) + len(pii.KINDS))
    weights[0] = 50.0
    model = pii.SpanModel(0.5, np.full((len(pii.LABELERS), 2, 3), 1 / 3), weights)
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = pii.found_spans(F.col("text"), model)
    row = table.select(spans.alias("spans"), pii.masked(F.col("text"), spans).alias("masked")).first()
    assert [pii.KINDS[s["kind"]] for s in row["spans"]] == [kind]
    first, last = text.split()[0], text.split()[-1]
    masked = row["masked"]
    assert masked.startswith(first) and masked.endswith(last)
    for part in (KEY[-40:], "host", "part", "b [dot]", "long.name"):
        assert part not in masked
