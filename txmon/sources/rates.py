"""Exchange rates from a table of quotes (units of a currency per US dollar)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fx_rates(quotes: DataFrame) -> DataFrame:
    """``(currency_code, units_per_usd)`` -> one ``(currency_code, usd_rate)`` per code.

    Codes are trimmed and upper-cased, only positive quotes count, and the dollar is
    always there at exactly 1. Where a code is quoted more than once the highest quote
    wins, so the result does not depend on row order.
    """
    dollar = quotes.sparkSession.range(0, 1, 1, 1).select(
        F.lit("USD").alias("currency_code"), F.lit(1.0).alias("units_per_usd")
    )
    code = F.col("currency_code")
    rate = F.when(code == "USD", 1.0).otherwise(1.0 / F.max("units_per_usd"))
    return (
        quotes.select(
            F.upper(F.trim("currency_code")).alias("currency_code"),
            F.expr("try_cast(units_per_usd AS double)").alias("units_per_usd"),
        )
        .where("units_per_usd > 0 AND NOT isnan(units_per_usd) AND currency_code IS NOT NULL")
        .unionByName(dollar)
        .groupBy(code)
        .agg(rate.alias("usd_rate"))
    )
