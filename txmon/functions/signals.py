"""Predicates on typed transactions, three-valued unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txmon.config import DEFAULT_RULES_CONFIG, RuleConfig


def cash_credit() -> Column:
    return (
        (F.col("direction") == "CREDIT")
        & (F.col("transaction_type") == "CASH")
        & F.col("booking_ts_ts").isNotNull()
    )


def wire_debit(cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> Column:
    return (F.col("direction") == "DEBIT") & transfer(cfg) & F.col("booking_ts_ts").isNotNull()


def transfer(cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> Column:
    return F.col("transaction_type").isin(*cfg.transfer_types)


def cross_border() -> Column:
    """Two known, different jurisdictions; never NULL."""
    origin, target = F.col("orig_home_jurisdiction_id"), F.col("ben_home_jurisdiction_id")
    return F.coalesce(origin != target, F.lit(False))


def folded(json_text: str) -> Column:
    """Lower-cased JSON text for substring tests, blank when missing."""
    return F.lower(F.coalesce(F.col(json_text), F.lit("")))


def near_threshold(cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> Column:
    """Cash in, just below the reporting threshold."""
    amount = F.col("amount_usd")
    return cash_credit() & (amount >= cfg.near_low) & (amount < cfg.near_high)


def high_risk_touch(cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> Column:
    """Either party at home in a high-risk country, or a geo event naming one; never NULL."""
    touches = F.col("geo_text").contains("high_risk_geo")
    for home in ("orig_home_jurisdiction_id", "ben_home_jurisdiction_id"):
        touches = F.coalesce(F.col(home).isin(*cfg.high_risk_countries), F.lit(False)) | touches
    return touches


def round_amount(cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> Column:
    """A whole number of round units; zero and negative amounts count."""
    return F.col("amount_usd") % cfg.round_unit == 0


def account_age_days() -> Column:
    """Calendar days from opening to booking; negative when booked before."""
    return F.datediff("booking_ts_ts", "acct_created_ts_ts")


def party_marked(*flags: str) -> Column:
    """Any of the flags is true, missing ones counting as false."""
    return F.coalesce(F.greatest(*(F.col(f) for f in flags)), F.lit(False))


def screened(text: str) -> Column:
    return F.col("screening_text").contains(text)
