"""Detection rules as data, the flags they set and the additive risk score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmon.config import DEFAULT_RULES_CONFIG, RuleConfig
from txmon.functions import signals


@dataclass(frozen=True)
class Rule:
    """One rule: its alert code, flag column, weight in the score and alert text.

    ``details`` maps labels to the columns whose values follow the text in the reason.
    A predicate that is NULL has not fired.
    """

    code: str
    flag: str
    weight: int
    text: str
    predicate: Callable[[RuleConfig], Column]
    details: dict[str, str] = field(default_factory=dict)

    def reason(self) -> Column:
        parts = [F.lit(self.text)]
        parts += [
            F.concat(F.lit(f"{label}="), F.col(column).cast("string"))
            for label, column in self.details.items()
        ]
        return F.concat_ws(" | ", *parts)


def _structuring(cfg: RuleConfig) -> Column:
    return signals.near_threshold(cfg) & (F.col("near_thr_cash_cnt") >= cfg.structuring_deposits)


def _smurfing(cfg: RuleConfig) -> Column:
    depositors = F.col("near_thr_cash_dist_depositors")
    return signals.near_threshold(cfg) & (depositors >= cfg.smurfing_depositors)


def _placement(cfg: RuleConfig) -> Column:
    young = signals.account_age_days() <= cfg.placement_age_days
    return F.col("is_cash_credit") & young & (F.col("amount_usd") >= cfg.placement_amount)


def _pass_through(cfg: RuleConfig) -> Column:
    return F.col("is_wire_debit") & (F.col("prev24h_credit_sum_usd") >= cfg.pass_through_credits)


def _round_transfer(cfg: RuleConfig) -> Column:
    return signals.round_amount(cfg) & signals.transfer(cfg)


def _sanctions(cfg: RuleConfig) -> Column:
    marked = signals.party_marked("orig_sanctions_flag", "ben_sanctions_flag")
    return marked | signals.screened('"decision":"reject"')


def _escalated(cfg: RuleConfig) -> Column:
    return signals.screened('"decision":"escalate"')


def _pep(cfg: RuleConfig) -> Column:
    return signals.party_marked("orig_pep_flag", "ben_pep_flag") | signals.screened("pep")


def _high_value_cross_border(cfg: RuleConfig) -> Column:
    by_message = F.col("pm_message_standard").isin(*cfg.message_standards)
    large = F.col("amount_usd") >= cfg.cross_border_amount
    return F.col("is_cross_border") & by_message & large


def _kyc_gap(cfg: RuleConfig) -> Column:
    level, amount = F.col("orig_kyc_level"), F.col("amount_usd")
    simplified = (level == "SIMPLIFIED") & (amount >= cfg.kyc_simplified_amount)
    risky_wire = F.col("is_wire_debit") & signals.high_risk_touch(cfg)
    enhanced = (level == "ENHANCED") & risky_wire & (amount >= cfg.kyc_enhanced_amount)
    return simplified | enhanced


def _dormant(cfg: RuleConfig) -> Column:
    return (F.col("acct_status") == "DORMANT") & (F.col("status") == "POSTED")


# --- fixed values: codes, flag names, weights and alert texts ---
RULES: tuple[Rule, ...] = (
    Rule(
        "STRUCTURING", "flag_structuring", 3,
        "Multiple cash deposits near threshold on same day", _structuring,
        {"count": "near_thr_cash_cnt", "sum_usd": "near_thr_cash_sum_usd"},
    ),
    Rule(
        "SMURFING", "flag_smurfing", 2,
        "Many distinct depositors near threshold on same day", _smurfing,
        {"distinct_depositors": "near_thr_cash_dist_depositors"},
    ),
    Rule(
        "PLACEMENT", "flag_placement", 2,
        "Cash into young account (<=30 days)", _placement,
    ),
    Rule(
        "LAYERING_PASS_THROUGH", "flag_layering_pass_through", 3,
        "Wire debit after large credits within 24h", _pass_through,
        {"prev24h_credit_sum_usd": "prev24h_credit_sum_usd"},
    ),
    Rule(
        "LAYERING_ROUND", "flag_layering_round", 0,
        "Round-dollar amount on WIRE/ACH/SEPA", _round_transfer,
    ),
    Rule(
        "SANCTIONS_HIT", "flag_sanctions_hit", 5,
        "Sanctions flag or screening reject", _sanctions,
    ),
    Rule(
        "SCREENING_ESCALATED", "flag_screening_escalated", 0,
        "Screening escalation", _escalated,
    ),
    Rule(
        "PEP", "flag_pep", 4,
        "PEP involvement (direct or screening)", _pep,
    ),
    Rule(
        "HIGH_VALUE_XBORDER", "flag_high_value_cross_border", 3,
        "High-value cross-border via SWIFT/ISO", _high_value_cross_border,
    ),
    Rule(
        "KYC_GAP", "flag_kyc_gap", 2,
        "KYC level vs amount/geo mismatch", _kyc_gap,
    ),
    Rule(
        "DORMANT_ACCOUNT_ACTIVITY", "flag_dormant_account_activity", 1,
        "Posted activity on dormant account", _dormant,
    ),
    Rule(
        "HIGH_RISK_GEO", "flag_high_risk_geo", 1,
        "High-risk geography (direct/derived)", signals.high_risk_touch,
    ),
    Rule(
        "ROUND_DOLLAR", "flag_round_dollar", 1,
        "Round-dollar anomaly", signals.round_amount,
    ),
)

FLAGS = tuple(rule.flag for rule in RULES)


def apply_rules(
    df: DataFrame, rules: Sequence[Rule] = RULES, cfg: RuleConfig = DEFAULT_RULES_CONFIG
) -> DataFrame:
    """Add one nullable boolean flag per rule."""
    return df.withColumns({rule.flag: rule.predicate(cfg) for rule in rules})


def with_risk_score(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``risk_score_simple``, the sum of the fired rules' weights."""
    points = [F.when(F.col(r.flag), F.lit(r.weight)).otherwise(F.lit(0)) for r in rules if r.weight]
    return df.withColumn("risk_score_simple", reduce(add, points, F.lit(0)))
