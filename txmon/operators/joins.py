"""Joins that hold up: with hot keys, and with small sides that are known to be small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def at_most(df: DataFrame, max_rows: int, else_say: str) -> DataFrame:
    """``df``, which fails when it is read if it has more rows; no job runs before that.

    Never more than ``max_rows + 1`` rows come together in a task.
    """
    everything = Window.partitionBy()
    names = df.columns
    counted = df.limit(max_rows + 1).withColumn("__rows", F.count(F.lit(1)).over(everything))
    fine = F.when(F.col("__rows") <= max_rows, True).otherwise(
        F.raise_error(F.lit(f"more than {max_rows} rows: {else_say}")).cast("boolean")
    )
    return counted.where(fine).select(*names)


def attach(
    df: DataFrame, side: DataFrame, keys: Sequence[str], match_unknown: bool = False
) -> DataFrame:
    """Left join of ``side``, unique by ``keys``; keeps the columns of ``df`` in front.

    As usual NULL matches nothing, unless ``match_unknown``. The comparison is null-safe
    in both cases, for the sake of hot keys: AQE splits a hot partition only if both
    inputs come straight from a shuffle. ``side`` is mostly an aggregate by the same keys,
    and for plain equality Spark would join it right where it was aggregated. Null-safe
    keys are partitioned in a way of their own, so the small side is shuffled once more
    and the large one can be split.
    """
    if not match_unknown:
        side = side.dropna(subset=list(keys))
    renamed = {key: f"__side_{key}" for key in keys}
    side = side.withColumnsRenamed(renamed)
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(new)) for key, new in renamed.items()))
    return df.join(side, same, "left").drop(*renamed.values())
