"""Bronze -> silver cleaning: each operator is one projection over the given columns.

Columns a file does not have are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmon.config import (
    CODE_COLUMNS,
    DELETED_COLUMNS,
    NULL_TOKENS,
    TEXT_COLUMNS,
    TIMESTAMP_COLUMNS,
)
from txmon.functions import text
from txmon.functions.timestamps import (
    among_shapes,
    digits_as_zero,
    parse_shaped,
    parse_timestamp,
    plain_notation,
    plain_number,
)


def _rewrite(df: DataFrame, columns: Iterable[str], rule: Callable[[Column], Column]) -> DataFrame:
    wanted = set(columns)
    return df.withColumns({c: rule(F.col(c)) for c in df.columns if c in wanted})


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn "no value" tokens into NULL in every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return _rewrite(df, strings, lambda c: text.blank_tokens(c, tokens))


def scrub_text(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    return _rewrite(df, columns, text.one_line)


def normalize_codes(df: DataFrame, columns: Sequence[str] = CODE_COLUMNS) -> DataFrame:
    return _rewrite(df, columns, text.code)


def parse_booleans(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """By default every ``*_flag`` column and the deletion markers."""
    if columns is None:
        columns = [c for c in df.columns if c.endswith("_flag") or c in DELETED_COLUMNS]
    return _rewrite(df, columns, text.truth)


def clean_amount(df: DataFrame) -> DataFrame:
    """Add ``amount_clean_str``, ``amount_num`` and ``dq_amount_invalid``.

    A missing or negative amount is invalid, but the row stays.
    """
    df = df.withColumn("amount_clean_str", text.amount_text(F.col("amount")))
    df = df.withColumn("amount_num", text.money(F.col("amount_clean_str")))
    return df.withColumn("dq_amount_invalid", unusable_amount(F.col("amount_num")).cast("int"))


def unusable_amount(amount: Column) -> Column:
    return F.coalesce(amount < 0, F.lit(True))


def parse_timestamps(df: DataFrame, columns: Sequence[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    """Add ``__norm_<c>`` and ``<c>_ts`` per column, and ``dq_booking_ts_unparsed``.

    The columns go through one array, so that the plan holds the long parsing expression
    once and not once per column: as many copies exceed what the JVM compiles. Texts of digits
    in a known layout are told by their shape; only others go through patterns.

    Write the result before filtering or joining on a ``*_ts`` column: Catalyst would
    otherwise copy the whole parse into every use of it.
    """
    present = [c for c in columns if c in df.columns]
    texts = F.array(*(F.col(c) for c in present))
    for step in (_zeroed, _shaped, _tidied, _numbered, _read):
        texts = F.transform(texts, step)
    added = {}
    for position, c in enumerate(present):
        added[f"__norm_{c}"] = F.col("__times")[position]["norm"]
        added[f"{c}_ts"] = F.col("__times")[position]["instant"]
    df = df.withColumn("__times", texts).withColumns(added).drop("__times")
    if "booking_ts" in present:
        unparsed = F.col("booking_ts_ts").isNull().cast("int")
        df = df.withColumn("dq_booking_ts_unparsed", unparsed)
    return df


def _zeroed(raw: Column) -> Column:
    return F.struct(raw.alias("raw"), digits_as_zero(raw).alias("zeros"))


def _shaped(t: Column) -> Column:
    return F.struct(t["raw"].alias("raw"), among_shapes(t["zeros"]).alias("shape"))


def _tidied(t: Column) -> Column:
    raw, shape = t["raw"], t["shape"]
    text = F.when(shape.isNotNull(), raw).otherwise(plain_notation(raw))
    return F.struct(raw.alias("raw"), shape.alias("shape"), text.alias("text"))


def _numbered(t: Column) -> Column:
    raw, shape = t["raw"], t["shape"]
    norm = F.when(shape.isNotNull(), raw).otherwise(plain_number(t["text"]))
    return F.struct(raw.alias("raw"), shape.alias("shape"), norm.alias("norm"))


def _read(t: Column) -> Column:
    raw, shape, norm = t["raw"], t["shape"], t["norm"]
    instant = F.when(shape.isNotNull(), parse_shaped(raw, shape)).otherwise(
        parse_timestamp(raw, norm)
    )
    return F.struct(norm.alias("norm"), instant.alias("instant"))
