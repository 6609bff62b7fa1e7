"""Conversion of amounts to US dollars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.config import MONEY
from txmon.operators.joins import at_most, attach

# One row per currency: the ISO list has under 200, so the bound is generous.
MAX_BROADCAST_RATES = 10_000


def needed_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """The rates of currencies that occur in the data."""
    used = df.select(F.upper(F.trim("currency_code")).alias("currency_code")).distinct()
    return rates.join(used, "currency_code")


def convert_to_usd(
    df: DataFrame, rates: DataFrame, many_rates: bool = False, max_rates: int = MAX_BROADCAST_RATES
) -> DataFrame:
    """Add ``usd_rate``, ``amount_usd`` and ``dq_fx_missing``; ``currency_code`` comes first.

    A currency without a rate, or none at all, converts at 1 and is marked missing.
    ``rates`` holds one row per code. It is broadcast, and the query fails if it has more than
    ``max_rates``: nothing is counted in advance. With ``many_rates`` it takes a shuffled join
    of any size, whose hot currencies AQE splits.
    """
    df = df.withColumn("currency_code", F.upper(F.trim("currency_code")))
    columns = ["currency_code", *(c for c in df.columns if c != "currency_code")]
    rates = rates.select("currency_code", "usd_rate")
    if many_rates:
        joined = attach(df, rates, ["currency_code"])
    else:
        small = at_most(rates, max_rates, "convert with many_rates")
        joined = df.join(F.broadcast(small), "currency_code", "left")
    rate = F.coalesce("usd_rate", F.lit(1.0))
    return joined.select(
        *columns,
        rate.alias("usd_rate"),
        (F.col("amount_num") * rate).try_cast(MONEY).alias("amount_usd"),
        F.col("usd_rate").isNull().cast("int").alias("dq_fx_missing"),
    )
