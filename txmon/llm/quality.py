"""Line-first cleaning: rules drop lines, then documents that lost too much text.

Only SQL functions: arrays of words and lines inside each row, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import WORD_SPACE, documents, let

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Not white space, as in the word rule.
_WORD = "[^ \\t-\\r]+"
_SPACES = "[ \\t-\\r]+"
# A mark that ends a sentence, at the end of a word.
_SENTENCE_END = "[.!?…][\"'”’»)\\]]*([ \\t-\\r]|$)"
_SHOUT = "[!?][!?]"
_SEPARATOR = "(^|[ \\t-\\r])[|>»·•/]+($|[ \\t-\\r])"
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "accept cookies",
    "use of cookies",
    "privacy policy",
    "terms of service",
    "terms of use",
    "enable javascript",
    "sign up for our newsletter",
    "subscribe to our",
    "click here",
    "skip to content",
    "powered by",
    "share this",
)


@dataclass(frozen=True)
class LineRules:
    """A line fails where a rule's share of its words is reached."""

    max_shout_percent: int = 30  # words with doubled exclamation or question marks
    max_symbol_percent: int = 30  # symbols such as # or | against words
    max_separator_percent: int = 20  # separators standing alone, as in menus
    boilerplate_max_words: int = 40  # phrases count against short lines only
    max_lost_percent: int = 50  # words lost with failed lines, of all words


def _removed(text: Column, characters: str) -> Column:
    """How many of the characters the text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words lying in a 3-word window that the text has twice or more.

    Windows are compared by 64-bit hashes; sorted with their places, equal ones are neighbours.
    """

    def covered(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(
            F.sort_array(placed),
            lambda s: let(
                F.sort_array(
                    F.transform(
                        F.filter(
                            s,
                            lambda x, k: (x["h"] == F.get(s, k - 1)["h"])
                            | (x["h"] == F.get(s, k + 1)["h"]),
                        ),
                        lambda x: x["i"],
                    )
                ),
                lambda at: F.aggregate(
                    F.transform(at, lambda p, k: F.least(F.get(at, k + 1) - p, F.lit(3))),
                    F.lit(0).cast("long"),
                    lambda total, step: total + F.coalesce(step, F.lit(3)),
                ),
            ),
        )

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: let(
            windows(hashes),
            lambda found: F.when(
                F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")
            ).otherwise(covered(found)),
        ),
    )


def _line_passes(line: Column, words: Column, rules: LineRules) -> Column:
    """Whether a line with ``words`` words stays; NULL for a line without words."""
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    shouts = F.when(F.contains(line, F.lit("!!")) | F.contains(line, F.lit("??")), F.regexp_count(
        line, F.lit(_SHOUT)
    )).otherwise(0)
    return F.when(
        words > 0,
        line.rlike(_SENTENCE_END)
        & (shouts * 100 < words * rules.max_shout_percent)
        & (_removed(line, SYMBOLS) * 100 < words * rules.max_symbol_percent)
        & (F.regexp_count(line, F.lit(_SEPARATOR)) * 100 < words * rules.max_separator_percent)
        & ~F.when(words <= rules.boilerplate_max_words, boilerplate).otherwise(False),
    )


def line_first(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document its word counts, its cleaned text and whether it is kept.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept_words, clean_text, kept``. Lines are split at ``\\n``; lines without
    words are dropped silently, lines failing a rule are removed with their words. A document
    goes when the base fails (under 50 words, or over half of them in repeated 3-word windows)
    or when it lost more than ``max_lost_percent`` of its words. A NULL text has no words and
    is not kept. Every row gives a row, repeated ones too. Columns named in ``carry`` are passed
    on after these, others are ignored.
    """
    blank = F.lit(WORD_SPACE)
    text = F.coalesce(F.col(text_col), F.lit(""))
    carried = {name: f"__carry_{name}" for name in carry}
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        *(F.col(name).alias(new) for name, new in carried.items()),
    ).select(
        "doc_id",
        *carried.values(),
        let(
            _words(F.col("text")),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                _repeated_words(words).alias("n_repeat_words"),
            ),
        ).alias("counts"),
        (F.length("text") - _removed(F.col("text"), WORD_SPACE)).cast("long").alias("word_chars"),
        _removed(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(
            F.filter(F.split("text", "\n"), lambda x: F.trim(x, blank) != ""),
            lambda lines: F.struct(
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dups"),
                F.filter(
                    F.transform(
                        lines,
                        lambda x: let(
                            F.regexp_count(x, F.lit(_WORD)),
                            lambda n: F.struct(
                                x.alias("line"),
                                n.alias("n"),
                                _line_passes(x, n, rules).alias("ok"),
                            ),
                        ),
                    ),
                    lambda x: x["ok"],
                ).alias("good"),
            ),
        ).alias("lines"),
    )
    words, repeated = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    base_failed = (words < MIN_WORDS) | (repeated * 100 > words * MAX_REPEAT_PERCENT)
    kept_words = F.aggregate(
        "lines.good", F.lit(0).cast("long"), lambda total, x: total + x["n"]
    )
    lost = (F.col("n_words") - F.col("kept_words")) * 100
    judged = counted.select(
        "doc_id",
        *carried.values(),
        words.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("lines.dups").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        kept_words.alias("kept_words"),
        F.array_join("lines.good.line", "\n").alias("clean_text"),
    ).withColumn(
        "kept", ~F.col("base_failed") & (lost <= F.col("n_words") * rules.max_lost_percent)
    )
    plain = [c for c in judged.columns if c not in carried.values()]
    return judged.select(*plain, *(F.col(new).alias(name) for name, new in carried.items()))


def op7_line_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_first(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "kept_words",
    )


_SQL_BOILERPLATE = " OR ".join(f"contains(lower(l), '{phrase}')" for phrase in BOILERPLATE)
OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls
  FROM d),
g AS (
  SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
       (SELECT unnest([0, 1, 2]) AS k)
  WHERE n > 1 GROUP BY doc_id),
f AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '[^ \\t-\\r]+')) AS n
  FROM (SELECT doc_id, unnest(ls) AS l FROM w)),
p AS (
  SELECT doc_id, sum(n) AS kept_words FROM f
  WHERE regexp_matches(l, '[.!?…]["''”’»)\\]]*([ \\t-\\r]|$)')
    AND 100 * len(regexp_extract_all(l, '[!?][!?]')) < 30 * n
    AND 100 * (length(l) - length(translate(l, '#*$%&|<>', ''))) < 30 * n
    AND 100 * len(regexp_extract_all(l, '(^|[ \\t-\\r])[|>»·•/]+($|[ \\t-\\r])')) < 20 * n
    AND NOT (n <= 40 AND ({_SQL_BOILERPLATE}))
  GROUP BY doc_id),
b AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT)
           AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(coalesce(kept_words, 0) AS BIGINT) AS kept_words
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN p USING (doc_id)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND 100 * (n_words - kept_words) <= 50 * n_words AS kept FROM v
"""
