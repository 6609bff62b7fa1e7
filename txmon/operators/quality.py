"""Data-quality summaries, all DataFrames: nothing is counted on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.config import CORE_COLUMNS


def null_profile(df: DataFrame, columns: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """Number of NULLs per column, in one row (NULL for an empty input)."""
    return df.agg(*(F.sum(F.col(c).isNull().cast("int")).alias(c) for c in columns))


def layer_counts(**layers: DataFrame) -> DataFrame:
    """``layer, rows`` for each given layer."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_figures(columns: Sequence[str] = CORE_COLUMNS) -> list[Column]:
    """Aggregates for ``observe``: rows, and NULLs per column as ``null_<column>``."""
    nulls = (F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns)
    return [F.count(F.lit(1)).alias("rows"), *nulls]


def observed_counts(spark: SparkSession, observed: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``layer, rows`` as counted while the layers were written."""
    rows = [(layer, figures["rows"]) for layer, figures in observed.items()]
    return spark.createDataFrame(rows, "layer string, rows long")


def observed_nulls(
    spark: SparkSession, figures: Mapping[str, int], columns: Sequence[str] = CORE_COLUMNS
) -> DataFrame:
    """What :func:`null_profile` returns, from figures observed while the layer was written."""
    schema = ", ".join(f"`{c}` long" for c in columns)
    row = tuple(figures[f"null_{c}"] if figures["rows"] else None for c in columns)
    return spark.createDataFrame([row], schema)


def _split(df: DataFrame, mark: str, label: str, when_set: str, otherwise: str) -> DataFrame:
    named = F.when(F.col(mark) == 1, F.lit(when_set)).otherwise(F.lit(otherwise))
    return df.groupBy(mark).count().withColumn(label, named)


def booking_quality(gold: DataFrame) -> DataFrame:
    return _split(gold, "dq_booking_ts_unparsed", "label", "Unparsed", "Parsed")


def booking_status(silver: DataFrame) -> DataFrame:
    return _split(
        silver, "dq_booking_ts_unparsed", "status", "Unparsed booking_ts", "Parsed booking_ts"
    ).select("status", "count")


def amount_quality(silver: DataFrame) -> DataFrame:
    return _split(silver, "dq_amount_invalid", "status", "Invalid Amount", "Valid Amount")


def amount_status(silver: DataFrame) -> DataFrame:
    return _split(
        silver, "dq_amount_invalid", "status", "Invalid amount", "Valid amount"
    ).select("status", "count")


def unparsed_preview(silver: DataFrame, rows: int = 50) -> DataFrame:
    """Unparsed booking times first, then by transaction id."""
    return (
        silver.select(
            "transaction_id",
            "booking_ts",
            "__norm_booking_ts",
            "booking_ts_ts",
            "dq_booking_ts_unparsed",
        )
        .orderBy(F.desc("dq_booking_ts_unparsed"), "transaction_id")
        .limit(rows)
    )
