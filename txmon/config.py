"""Fixed values of the data model and the tunable thresholds of the rules."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# --- fixed values: spellings of "no value" in raw files (compared case-sensitively) ---
NULL_TOKENS = ("UNKNOWN", "NULL", "null", "N/A", "na", "")

# --- fixed values: raw columns by kind ---
CORE_COLUMNS = (
    "transaction_id", "account_id", "amount", "currency_code",
    "direction", "transaction_type", "booking_ts",
)
TEXT_COLUMNS = (
    "reference", "pm_raw_payload", "pm_parsed_payload_json",
    "iso_parties_by_role_json", "screening_events_json", "geo_events_json",
)
CODE_COLUMNS = (
    "currency_code", "direction", "channel", "status", "transaction_type",
    "source_system", "acct_currency_code", "pm_direction", "pm_message_standard",
)
DELETED_COLUMNS = (
    "is_deleted", "acct_is_deleted", "pm_is_deleted", "orig_is_deleted_x",
    "orig_is_deleted_y", "ben_is_deleted_x", "ben_is_deleted_y", "cp_is_deleted",
)
TIMESTAMP_COLUMNS = (
    "booking_ts", "created_ts", "updated_ts", "record_effective_start_ts",
    "acct_created_ts", "acct_updated_ts",
    "orig_created_ts_x", "orig_updated_ts_x", "orig_created_ts_y", "orig_updated_ts_y",
    "ben_created_ts_x", "ben_updated_ts_x", "ben_created_ts_y", "ben_updated_ts_y",
    "pm_created_ts", "pm_updated_ts",
    "orig_profile_ts", "ben_profile_ts", "pm_record_effective_start_ts",
)

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds and code lists the rules read. Amounts are US dollars."""

    # --- fixed values: default policy ---
    near_low: Decimal = Decimal("8000.00")
    near_high: Decimal = Decimal("10000.00")
    structuring_deposits: int = 2
    smurfing_depositors: int = 3
    placement_age_days: int = 30
    placement_amount: Decimal = Decimal("5000.00")
    pass_through_credits: Decimal = Decimal("10000.00")
    cross_border_amount: Decimal = Decimal("100000.00")
    kyc_simplified_amount: Decimal = Decimal("10000.00")
    kyc_enhanced_amount: Decimal = Decimal("50000.00")
    round_unit: int = 100
    credit_lookback_seconds: int = 24 * 3600
    burst_radius_seconds: int = 10 * 60
    transfer_types: tuple[str, ...] = ("WIRE", "ACH", "SEPA")
    message_standards: tuple[str, ...] = ("SWIFT_MT", "ISO20022_MX")
    high_risk_countries: tuple[str, ...] = ("RU", "IR", "SY")


DEFAULT_RULES_CONFIG = RuleConfig()
