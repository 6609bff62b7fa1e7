"""Long-form alerts: one row per transaction and fired rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.operators.joins import attach
from txmon.operators.rules import RULES, Rule


def to_alerts(gold: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Gold -> alerts, without a shuffle.

    Each row collects its fired rules and yields only those, so no row is widened to the
    full set of rules first.
    """
    fired = F.array_compact(
        F.array(
            *(
                F.when(
                    F.col(rule.flag),
                    F.struct(
                        F.lit(rule.code).alias("alert_type"), rule.reason().alias("alert_reason")
                    ),
                )
                for rule in rules
            )
        )
    )
    return gold.select(
        "transaction_id",
        "account_id",
        "amount_usd",
        F.col("booking_ts_ts").alias("booking_ts"),
        F.col("risk_score_simple").alias("tx_risk_score"),
        F.inline(fired),
    ).select(
        "transaction_id",
        "account_id",
        "amount_usd",
        "booking_ts",
        "alert_type",
        "alert_reason",
        "tx_risk_score",
    )


def has_alert(gold: DataFrame, alerts: DataFrame) -> DataFrame:
    """Every gold row with 1 where its transaction id has an alert, else 0."""
    alerted = alerts.select("transaction_id").distinct().withColumn("has_alert", F.lit(1))
    columns = ["transaction_id", "amount_usd", "risk_score_simple", "transaction_type"]
    marked = attach(gold.select(*columns), alerted, ["transaction_id"])
    return marked.withColumn("has_alert", F.coalesce("has_alert", F.lit(0)))
