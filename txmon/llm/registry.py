"""The queries of this subpackage and the SQL they are checked with."""

from __future__ import annotations

from txmon.llm import (
    bpe,
    collocations,
    exact_dedup,
    jaccard,
    mixing,
    packing,
    pii,
    quality,
    sentence_spans,
    sharding,
    suffix_repeats,
    warc,
    whitening,
)
from txmon.llm.common import ship_code


def _shipped(query):
    def run(spark, sf_dir):
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    found = {
        "op1_warc_derivatives": warc.op1_warc_derivatives,
        "op2_weak_supervision": pii.op2_weak_supervision,
        "op3_heavy_light_join": jaccard.op3_heavy_light_join,
        "op4_sentence_spans": sentence_spans.op4_sentence_spans,
        "op5_interval_tree": suffix_repeats.op5_interval_tree,
        "op6_bounded_ring": sharding.op6_bounded_ring,
        "op7_line_first": quality.op7_line_first,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op9_byte_bpe": bpe.op9_byte_bpe,
        "op10_power_of_two": packing.op10_power_of_two,
        "op11_mixed_precision": whitening.op11_mixed_precision,
        "op12_fair_queue": mixing.op12_fair_queue,
        "op13_quotient_filters": collocations.op13_quotient_filters,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_derivatives": warc.OP1_SQL,
        "op4_sentence_spans": sentence_spans.OP4_SQL,
        "op7_line_first": quality.OP7_SQL,
        "op8_exact_dedup": exact_dedup.OP8_SQL,
        "op12_fair_queue": mixing.OP12_SQL,
        "op13_quotient_filters": collocations.OP13_SQL,
    }
