from __future__ import annotations

import dataclasses
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txmon.config import RuleConfig
from txmon.operators.alerts import has_alert, to_alerts
from txmon.operators.features import with_gold_helpers
from txmon.operators.rules import FLAGS, RULES, apply_rules, with_risk_score
from txmon.plans import pipeline
from workload.transactions import transactions

SCHEMA = (
    "transaction_id string, account_id string, booking_ts_ts timestamp, amount_usd decimal(18,2),"
    "direction string, transaction_type string, orig_home_jurisdiction_id string,"
    "ben_home_jurisdiction_id string, screening_events_json string, geo_events_json string,"
    "orig_sanctions_flag boolean, ben_sanctions_flag boolean, orig_pep_flag boolean,"
    "ben_pep_flag boolean, pm_message_standard string, orig_kyc_level string, acct_status string,"
    "status string, acct_created_ts_ts timestamp, near_thr_cash_cnt bigint,"
    "near_thr_cash_sum_usd decimal(28,2), near_thr_cash_dist_depositors bigint,"
    "prev24h_credit_sum_usd decimal(28,2)"
)
PLAIN = {
    "transaction_id": "T1", "account_id": "A", "booking_ts_ts": dt.datetime(2026, 1, 31, 12),
    "amount_usd": Decimal("50.01"), "direction": "CREDIT", "transaction_type": "CARD",
    "acct_created_ts_ts": dt.datetime(2020, 1, 1), "near_thr_cash_cnt": 0,
    "near_thr_cash_sum_usd": Decimal(0), "near_thr_cash_dist_depositors": 0,
    "prev24h_credit_sum_usd": Decimal(0),
}
CASH = {"transaction_type": "CASH"}
WIRE = {"direction": "DEBIT", "transaction_type": "WIRE"}
NEAR = {**CASH, "amount_usd": Decimal("8000.01")}
ABROAD = {"orig_home_jurisdiction_id": "US", "ben_home_jurisdiction_id": "GB"}
BIG = {"amount_usd": Decimal("100000.01")}


def scored(spark, *changes, cfg=RuleConfig()):
    names = [part.split()[0] for part in SCHEMA.split(",") if " " in part]
    rows = [tuple({**PLAIN, **change}.get(name) for name in names) for change in changes]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    return with_risk_score(apply_rules(with_gold_helpers(df, cfg), cfg=cfg))


def fired(row):
    return {rule.code for rule in RULES if row[rule.flag]}


CASES = [
    ({}, set()),
    ({**NEAR, "near_thr_cash_cnt": 2}, {"STRUCTURING"}),
    ({**NEAR, "near_thr_cash_cnt": 1}, set()),
    ({**NEAR, "near_thr_cash_cnt": 3, "near_thr_cash_dist_depositors": 3},
     {"STRUCTURING", "SMURFING"}),
    ({**NEAR, "near_thr_cash_cnt": 2, "booking_ts_ts": None}, set()),
    ({**CASH, "amount_usd": Decimal("10000.01"), "near_thr_cash_cnt": 5}, set()),
    ({**CASH, "amount_usd": Decimal("5000.01"), "acct_created_ts_ts": dt.datetime(2026, 1, 1, 23)},
     {"PLACEMENT"}),
    ({**CASH, "amount_usd": Decimal("5000.01"), "acct_created_ts_ts": dt.datetime(2025, 12, 31)},
     set()),
    ({**CASH, "amount_usd": Decimal("5000.01"), "acct_created_ts_ts": dt.datetime(2027, 1, 1)},
     {"PLACEMENT"}),
    ({**CASH, "amount_usd": Decimal("5000.01"), "acct_created_ts_ts": None}, set()),
    ({**WIRE, "prev24h_credit_sum_usd": Decimal("10000.00")}, {"LAYERING_PASS_THROUGH"}),
    ({**WIRE, "prev24h_credit_sum_usd": Decimal("9999.99")}, set()),
    ({"transaction_type": "SEPA", "amount_usd": Decimal("-200")},
     {"LAYERING_ROUND", "ROUND_DOLLAR"}),
    ({"amount_usd": Decimal("0")}, {"ROUND_DOLLAR"}),
    ({"orig_sanctions_flag": True}, {"SANCTIONS_HIT"}),
    ({"orig_sanctions_flag": False, "ben_sanctions_flag": True}, {"SANCTIONS_HIT"}),
    ({"screening_events_json": '{"Decision":"Reject"}'}, {"SANCTIONS_HIT"}),
    ({"screening_events_json": '{"decision": "reject"}'}, set()),
    ({"screening_events_json": '{"decision":"ESCALATE"}'}, {"SCREENING_ESCALATED"}),
    ({"ben_pep_flag": True}, {"PEP"}),
    ({"screening_events_json": "pepper"}, {"PEP"}),
    ({**BIG, **ABROAD, "pm_message_standard": "SWIFT_MT"}, {"HIGH_VALUE_XBORDER"}),
    ({**BIG, **ABROAD, "pm_message_standard": None}, set()),
    ({**BIG, "orig_home_jurisdiction_id": "US", "pm_message_standard": "SWIFT_MT"}, set()),
    ({"orig_kyc_level": "SIMPLIFIED", "amount_usd": Decimal("10000.01")}, {"KYC_GAP"}),
    ({"orig_kyc_level": "simplified", "amount_usd": Decimal("10000.01")}, set()),
    ({**WIRE, "orig_kyc_level": "ENHANCED", "amount_usd": Decimal("50000.01"),
      "ben_home_jurisdiction_id": "IR"}, {"KYC_GAP", "HIGH_RISK_GEO"}),
    ({"acct_status": "DORMANT", "status": "POSTED"}, {"DORMANT_ACCOUNT_ACTIVITY"}),
    ({"acct_status": "DORMANT", "status": None}, set()),
    ({"geo_events_json": "a HIGH_RISK_GEO b"}, {"HIGH_RISK_GEO"}),
    ({"orig_home_jurisdiction_id": "SY"}, {"HIGH_RISK_GEO"}),
    ({"amount_usd": None}, set()),
]


def test_each_rule(spark):
    changes = [{**change, "transaction_id": str(i)} for i, (change, _) in enumerate(CASES)]
    rows = {int(r["transaction_id"]): r for r in scored(spark, *changes).collect()}
    weights = {rule.code: rule.weight for rule in RULES}
    for i, (change, codes) in enumerate(CASES):
        assert fired(rows[i]) == codes, change
        assert rows[i]["risk_score_simple"] == sum(weights[c] for c in codes)


def test_flags_keep_unknown(spark):
    row = scored(spark, {"amount_usd": None, **CASH, "near_thr_cash_cnt": 2}).first()
    assert row["flag_structuring"] is None and row["flag_round_dollar"] is None
    assert row["flag_sanctions_hit"] is False and row["flag_high_risk_geo"] is False


def test_thresholds_are_settings(spark):
    strict = dataclasses.replace(RuleConfig(), high_risk_countries=("US",), near_low=Decimal(1))
    change = {"orig_home_jurisdiction_id": "US", **CASH, "near_thr_cash_cnt": 2}
    assert fired(scored(spark, change).first()) == set()
    assert fired(scored(spark, change, cfg=strict).first()) == {"HIGH_RISK_GEO", "STRUCTURING"}


def test_alerts_and_reasons(spark):
    gold = scored(
        spark,
        {**NEAR, "transaction_id": "T1", "near_thr_cash_cnt": 3, "near_thr_cash_dist_depositors": 4,
         "near_thr_cash_sum_usd": Decimal("26000.50")},
        {**WIRE, "transaction_id": "T2", "prev24h_credit_sum_usd": Decimal("12345678.90")},
        {"transaction_id": "T3"},
    )
    alerts = to_alerts(gold)
    assert alerts.columns == [
        "transaction_id", "account_id", "amount_usd", "booking_ts",
        "alert_type", "alert_reason", "tx_risk_score",
    ]
    reasons = {(r["transaction_id"], r["alert_type"]): r["alert_reason"] for r in alerts.collect()}
    assert reasons == {
        ("T1", "STRUCTURING"):
            "Multiple cash deposits near threshold on same day | count=3 | sum_usd=26000.50",
        ("T1", "SMURFING"):
            "Many distinct depositors near threshold on same day | distinct_depositors=4",
        ("T2", "LAYERING_PASS_THROUGH"):
            "Wire debit after large credits within 24h | prev24h_credit_sum_usd=12345678.90",
    }
    marks = {r["transaction_id"]: r["has_alert"] for r in has_alert(gold, alerts).collect()}
    assert marks == {"T1": 1, "T2": 1, "T3": 0}


# Hits per rule, measured with independent SQL.
HITS = {
    "flag_structuring": 80, "flag_smurfing": 15, "flag_placement": 744,
    "flag_layering_pass_through": 3690, "flag_layering_round": 161, "flag_sanctions_hit": 603,
    "flag_screening_escalated": 496, "flag_pep": 634, "flag_high_value_cross_border": 49,
    "flag_kyc_gap": 1263, "flag_dormant_account_activity": 734, "flag_high_risk_geo": 5088,
    "flag_round_dollar": 387,
}


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    pipeline.gold(transactions(spark, "/root/testdata/sf0.01")).write.parquet(path)
    return spark.read.parquet(path)


def test_hits_on_the_test_tables(gold):
    totals = gold.agg(*(F.count_if(F.col(f)).alias(f) for f in FLAGS)).first().asDict()
    assert totals == HITS
    extremes = gold.agg(F.min("risk_score_simple"), F.max("risk_score_simple")).first()
    assert tuple(extremes) == (0, 16)
    assert gold.agg(F.max("rapid_seq_txn_cnt")).first()[0] == 5
    assert to_alerts(gold).count() == sum(HITS.values())


def test_invariants(gold):
    cash = "(flag_structuring OR flag_smurfing OR flag_placement)"
    broken = gold.where(
        f"(flag_smurfing AND NOT flag_structuring) OR (flag_layering_round AND NOT flag_round_dollar)"
        f" OR ({cash} AND flag_layering_pass_through) OR risk_score_simple NOT BETWEEN 0 AND 20"
    )
    assert broken.count() == 0
    assert sum(rule.weight for rule in RULES) == 27


def test_gold_columns_in_order(gold):
    names = gold.columns
    assert names[:2] == ["account_id", "booking_date"]
    tail = [
        "near_thr_cash_cnt", "near_thr_cash_sum_usd", "near_thr_cash_dist_depositors",
        "ts_sec", "prev24h_credit_sum_usd", "rapid_seq_txn_cnt", *FLAGS, "risk_score_simple",
    ]
    assert names[-len(tail):] == tail
    types = dict(gold.dtypes)
    assert types["prev24h_credit_sum_usd"] == "decimal(28,2)"
    assert types["near_thr_cash_cnt"] == types["rapid_seq_txn_cnt"] == "bigint"
    assert types["risk_score_simple"] == "int"
