"""The expected results as DuckDB SQL, written independently of the Spark code.

Times in raw text are not parsed here: the SQL knows which instant each text was made
from, and so what a right parse must give.
"""

from __future__ import annotations

# Spelled out, so that a column missing from the code under test is missed here.
# --- fixed values ---
DELETED_COLUMNS = (
    "is_deleted", "acct_is_deleted", "pm_is_deleted", "orig_is_deleted_x", "orig_is_deleted_y",
    "ben_is_deleted_x", "ben_is_deleted_y", "cp_is_deleted",
)
TIMESTAMP_COLUMNS = (
    "booking_ts", "created_ts", "updated_ts", "record_effective_start_ts", "acct_created_ts",
    "acct_updated_ts", "orig_created_ts_x", "orig_updated_ts_x", "orig_created_ts_y",
    "orig_updated_ts_y", "ben_created_ts_x", "ben_updated_ts_x", "ben_created_ts_y",
    "ben_updated_ts_y", "pm_created_ts", "pm_updated_ts", "orig_profile_ts", "ben_profile_ts",
    "pm_record_effective_start_ts",
)

TYPED = """
typed AS (
  SELECT 'T' || e.event_id AS transaction_id,
         'A' || e.account AS account_id,
         e.ts AS booking_ts_ts,
         CAST(round(e.value * 400, 2) AS DECIMAL(18,2)) AS amount_usd,
         CASE WHEN e.event_type IN ('click','error') THEN 'DEBIT' ELSE 'CREDIT' END AS direction,
         CASE e.event_type WHEN 'click' THEN 'WIRE'
              WHEN 'error' THEN CASE WHEN e.event_id % 2 = 0 THEN 'ACH' ELSE 'SEPA' END
              WHEN 'purchase' THEN 'CARD' ELSE 'CASH' END AS transaction_type,
         'P' || (e.event_id % 97) AS originator_party_id,
         CASE WHEN e.account % 10 = 0 THEN 'DORMANT' ELSE 'ACTIVE' END AS acct_status,
         CASE WHEN e.event_id % 4 = 0 THEN 'PENDING' ELSE 'POSTED' END AS status,
         CASE e.event_id % 3 WHEN 0 THEN 'SWIFT_MT' WHEN 1 THEN 'ISO20022_MX' END
           AS pm_message_standard,
         CAST(DATE '2024-01-01' - CAST(3 * e.account AS INTEGER) AS TIMESTAMP)
           AS acct_created_ts_ts,
         (e.event_id % 97) % 31 = 0 AS orig_pep_flag,
         (e.event_id % 97) % 41 = 0 AS orig_sanctions_flag,
         CAST(NULL AS BOOLEAN) AS ben_pep_flag,
         CAST(NULL AS BOOLEAN) AS ben_sanctions_flag,
         CASE WHEN k < 3 THEN '{"decision":"REJECT"}' WHEN k < 8 THEN '{"decision":"ESCALATE"}'
              WHEN k < 10 THEN '{"list":"PEP"}' END AS screening_events_json,
         CASE WHEN k = 50 THEN '{"type":"HIGH_RISK_GEO"}' END AS geo_events_json,
         ['ONLINE','BRANCH','ATM','MOBILE'][1 + e.event_id % 4] AS channel,
         ['USD','EUR','GBP','INR','JPY','XXX',NULL][1 + e.event_id % 7] AS currency_code,
         e.event_id,
         ['US','GB','DE','FR','IN','SG','RU','AE','IR','SY'][1 + c.c_nationkey % 10]
           AS orig_home_jurisdiction_id,
         CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'SIMPLIFIED' WHEN 'AUTOMOBILE' THEN 'ENHANCED'
              ELSE CASE WHEN c.c_custkey IS NOT NULL THEN 'STANDARD' END END AS orig_kyc_level,
         ['US','GB','DE','FR','IN','SG','RU','AE','IR','SY'][1 + s.s_nationkey % 10]
           AS ben_home_jurisdiction_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
               CASE WHEN user_id % 5 = 0 THEN user_id ELSE user_id % 20 END AS account
        FROM events) e
  LEFT JOIN customer c ON c.c_custkey = e.event_id * 3 // 20
  LEFT JOIN supplier s ON s.s_suppkey = e.event_id // 100
)"""

GOLD = """
helped AS (
  SELECT *, CAST(booking_ts_ts AS DATE) AS booking_date,
         direction = 'CREDIT' AND transaction_type = 'CASH' AND booking_ts_ts IS NOT NULL
           AS is_cash_credit,
         direction = 'DEBIT' AND transaction_type IN ('WIRE','ACH','SEPA')
           AND booking_ts_ts IS NOT NULL AS is_wire_debit,
         orig_home_jurisdiction_id IS NOT NULL AND ben_home_jurisdiction_id IS NOT NULL
           AND orig_home_jurisdiction_id <> ben_home_jurisdiction_id AS is_cross_border,
         lower(coalesce(screening_events_json, '')) AS screening_text,
         lower(coalesce(geo_events_json, '')) AS geo_text,
         CAST(floor(epoch(booking_ts_ts)) AS BIGINT) AS ts_sec
  FROM {source}
), near AS (
  SELECT account_id, booking_date, count(*) AS near_thr_cash_cnt,
         CAST(sum(amount_usd) AS DECIMAL(28,2)) AS near_thr_cash_sum_usd,
         count(DISTINCT originator_party_id) AS near_thr_cash_dist_depositors
  FROM helped WHERE is_cash_credit AND amount_usd >= 8000 AND amount_usd < 10000
  GROUP BY account_id, booking_date
), featured AS (
  SELECT h.*, coalesce(n.near_thr_cash_cnt, 0) AS near_thr_cash_cnt,
         CAST(coalesce(n.near_thr_cash_sum_usd, 0) AS DECIMAL(28,2)) AS near_thr_cash_sum_usd,
         coalesce(n.near_thr_cash_dist_depositors, 0) AS near_thr_cash_dist_depositors,
         CAST(coalesce(sum(CASE WHEN h.direction = 'CREDIT' THEN h.amount_usd ELSE 0 END) OVER (
           PARTITION BY h.account_id ORDER BY h.ts_sec NULLS FIRST
           RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(28,2))
           AS prev24h_credit_sum_usd,
         count(*) OVER (PARTITION BY h.account_id ORDER BY h.ts_sec NULLS FIRST
           RANGE BETWEEN 600 PRECEDING AND 600 FOLLOWING) AS rapid_seq_txn_cnt,
         coalesce(h.orig_home_jurisdiction_id, '') IN ('RU','IR','SY')
           OR coalesce(h.ben_home_jurisdiction_id, '') IN ('RU','IR','SY')
           OR contains(h.geo_text, 'high_risk_geo') AS geo_touch
  FROM helped h LEFT JOIN near n
    ON n.account_id = h.account_id AND n.booking_date = h.booking_date
), flagged AS (
  SELECT *,
    is_cash_credit AND amount_usd >= 8000 AND amount_usd < 10000 AND near_thr_cash_cnt >= 2
      AS flag_structuring,
    is_cash_credit AND amount_usd >= 8000 AND amount_usd < 10000
      AND near_thr_cash_dist_depositors >= 3 AS flag_smurfing,
    is_cash_credit AND date_diff('day', CAST(acct_created_ts_ts AS DATE), booking_date) <= 30
      AND amount_usd >= 5000 AS flag_placement,
    is_wire_debit AND prev24h_credit_sum_usd >= 10000 AS flag_layering_pass_through,
    (amount_usd % 100 = 0) AND transaction_type IN ('WIRE','ACH','SEPA') AS flag_layering_round,
    coalesce(orig_sanctions_flag, false) OR coalesce(ben_sanctions_flag, false)
      OR contains(screening_text, '"decision":"reject"') AS flag_sanctions_hit,
    contains(screening_text, '"decision":"escalate"') AS flag_screening_escalated,
    coalesce(orig_pep_flag, false) OR coalesce(ben_pep_flag, false)
      OR contains(screening_text, 'pep') AS flag_pep,
    is_cross_border AND pm_message_standard IN ('SWIFT_MT','ISO20022_MX') AND amount_usd >= 100000
      AS flag_high_value_cross_border,
    (orig_kyc_level = 'SIMPLIFIED' AND amount_usd >= 10000)
      OR (orig_kyc_level = 'ENHANCED' AND is_wire_debit AND geo_touch AND amount_usd >= 50000)
      AS flag_kyc_gap,
    acct_status = 'DORMANT' AND status = 'POSTED' AS flag_dormant_account_activity,
    geo_touch AS flag_high_risk_geo,
    amount_usd % 100 = 0 AS flag_round_dollar
  FROM featured
), gold AS (
  SELECT *, CAST(
      CASE WHEN flag_structuring THEN 3 ELSE 0 END + CASE WHEN flag_smurfing THEN 2 ELSE 0 END
    + CASE WHEN flag_placement THEN 2 ELSE 0 END
    + CASE WHEN flag_layering_pass_through THEN 3 ELSE 0 END
    + CASE WHEN flag_sanctions_hit THEN 5 ELSE 0 END + CASE WHEN flag_pep THEN 4 ELSE 0 END
    + CASE WHEN flag_high_value_cross_border THEN 3 ELSE 0 END
    + CASE WHEN flag_kyc_gap THEN 2 ELSE 0 END
    + CASE WHEN flag_dormant_account_activity THEN 1 ELSE 0 END
    + CASE WHEN flag_high_risk_geo THEN 1 ELSE 0 END
    + CASE WHEN flag_round_dollar THEN 1 ELSE 0 END AS INTEGER) AS risk_score_simple
  FROM flagged
)"""

# code, flag, reason as SQL
ALERT_RULES = (
    ("STRUCTURING", "flag_structuring",
     "'Multiple cash deposits near threshold on same day | count=' || near_thr_cash_cnt"
     " || ' | sum_usd=' || near_thr_cash_sum_usd"),
    ("SMURFING", "flag_smurfing",
     "'Many distinct depositors near threshold on same day | distinct_depositors='"
     " || near_thr_cash_dist_depositors"),
    ("PLACEMENT", "flag_placement", "'Cash into young account (<=30 days)'"),
    ("LAYERING_PASS_THROUGH", "flag_layering_pass_through",
     "'Wire debit after large credits within 24h | prev24h_credit_sum_usd='"
     " || prev24h_credit_sum_usd"),
    ("LAYERING_ROUND", "flag_layering_round", "'Round-dollar amount on WIRE/ACH/SEPA'"),
    ("SANCTIONS_HIT", "flag_sanctions_hit", "'Sanctions flag or screening reject'"),
    ("SCREENING_ESCALATED", "flag_screening_escalated", "'Screening escalation'"),
    ("PEP", "flag_pep", "'PEP involvement (direct or screening)'"),
    ("HIGH_VALUE_XBORDER", "flag_high_value_cross_border",
     "'High-value cross-border via SWIFT/ISO'"),
    ("KYC_GAP", "flag_kyc_gap", "'KYC level vs amount/geo mismatch'"),
    ("DORMANT_ACCOUNT_ACTIVITY", "flag_dormant_account_activity",
     "'Posted activity on dormant account'"),
    ("HIGH_RISK_GEO", "flag_high_risk_geo", "'High-risk geography (direct/derived)'"),
    ("ROUND_DOLLAR", "flag_round_dollar", "'Round-dollar anomaly'"),
)

ALERTS = "alerts AS (" + " UNION ALL ".join(
    f"""
  SELECT transaction_id, account_id, amount_usd, booking_ts_ts AS booking_ts,
         '{code}' AS alert_type, {reason} AS alert_reason, risk_score_simple AS tx_risk_score
  FROM gold WHERE {flag}"""
    for code, flag, reason in ALERT_RULES
) + ")"

RATES = """
rates AS (
  SELECT * FROM (VALUES ('USD', 1.0::DOUBLE), ('EUR', 1 / 0.8::DOUBLE), ('GBP', 1 / 0.625::DOUBLE),
    ('INR', 1 / 80.0::DOUBLE), ('JPY', 1 / 100.0::DOUBLE), ('CHF', 1 / 0.5::DOUBLE))
    AS r(currency_code, usd_rate)
)"""

# DuckDB layouts of the rendered times, and the precision a right parse recovers.
_RENDERED = (
    ("%d-%m-%Y %H:%M", "minute"), ("%d-%m-%Y %H:%M:%S", "second"), ("%d-%m-%Y", "day"),
    ("%m/%d/%Y %H:%M:%S", "second"), ("%m/%d/%Y %I:%M:%S %p", "second"), ("%m/%d/%Y", "day"),
    ("%d/%m/%Y %H:%M:%S", "swapped second"), ("%d/%m/%Y", "swapped day"),
    ("%b %d %Y %H:%M:%S", "second"), ("%b-%d-%Y %H:%M:%S", "second"),
    ("%Y.%m.%d %H:%M:%S", "second"), ("%Y/%m/%d %H:%M:%S", "second"),
    ("%Y/%m/%d %H:%M", "minute"), ("%Y-%m-%d %H:%M:%S", "second"), ("%Y-%m-%d %H:%M", "minute"),
    ("%Y%m%d", "day"), ("%Y%m%d %H%M%S", "second"), ("%Y%m%d %H%M", "minute"),
    ("%Y-%j %H:%M:%S", "second"),
    ("%Y-%m-%dT%H:%M:%SZ", "second"), ("%Y-%m-%dT%H:%M:%S+05:30", "offset second"),
    ("%Y-%m-%d_%H:%M:%S UTC", "second"),
)
_NOT_TIMES = ("'UNKNOWN'", "'45:00.0'", "'2.02601E+13'", "'31-02-2026'", "NULL")
_VARIANTS = len(_RENDERED) + len(_NOT_TIMES)


def time_text(position: int, instant: str = "booking_ts_ts") -> str:
    arms = [f"WHEN {i} THEN strftime({instant}, '{f}')" for i, (f, _) in enumerate(_RENDERED)]
    arms += [f"WHEN {i} THEN {v}" for i, v in enumerate(_NOT_TIMES, start=len(_RENDERED))]
    return f"CASE (event_id + {5 * position}) % {_VARIANTS} {' '.join(arms)} END"


def time_truth(position: int, instant: str = "booking_ts_ts") -> str:
    arms = []
    for i, (_, precision) in enumerate(_RENDERED):
        *change, unit = precision.split()
        value = f"date_trunc('{unit}', {instant})"
        if change == ["offset"]:
            value += " - INTERVAL '5 hours 30 minutes'"
        if change == ["swapped"]:
            # An ambiguous slash date is read month-first.
            time = f"{value} - date_trunc('day', {instant})"
            swapped = f"make_timestamp(year({instant}), day({instant}), month({instant}), 0, 0, 0)"
            value = f"CASE WHEN day({instant}) <= 12 THEN {swapped} + ({time}) ELSE {value} END"
        arms.append(f"WHEN {i} THEN CAST({value} AS TIMESTAMP)")
    return f"CASE (event_id + {5 * position}) % {_VARIANTS} {' '.join(arms)} END"


_GROUPED = "format('{:,.2f}', CAST(amount_usd AS DOUBLE))"
_CURRENCY = "' ' || lower(currency_code)"
RAW_COLUMNS = {
    "transaction_id": "transaction_id",
    "account_id": "account_id",
    "amount": f"""CASE WHEN event_id % 11 = 0 THEN '$' || {_GROUPED}
        WHEN event_id % 11 = 1 THEN '(' || {_GROUPED} || ')'
        WHEN event_id % 11 = 2 THEN '-' || amount_usd
        WHEN event_id % 11 = 3 THEN ' ' || amount_usd || ' USD'
        WHEN event_id % 11 = 4 THEN amount_usd || '0'
        WHEN event_id % 110 = 5 THEN 'abc' WHEN event_id % 110 = 16 THEN '1.2.3'
        WHEN event_id % 110 = 27 THEN 'N/A' WHEN event_id % 110 = 38 THEN '1.2E5'
        WHEN event_id % 110 = 49 THEN '1.005' ELSE CAST(amount_usd AS VARCHAR) END""",
    "currency_code": _CURRENCY,
    "direction": "CASE WHEN event_id % 2 = 0 THEN lower(direction) ELSE direction END",
    "transaction_type": "transaction_type || ' '",
    "booking_ts": time_text(0),
    "originator_party_id": "originator_party_id",
    "counterparty_party_id":
        "[' UNKNOWN ', 'Unknown', 'N/A', ' x ', 'na', 'NA'][1 + event_id % 6]",
    "channel": "upper(channel[1]) || lower(channel[2:])",
    "status": "lower(status)",
    "source_system": "['core', ' swift', 'NULL'][1 + event_id % 3]",
    "acct_currency_code": "lower(currency_code)",
    "pm_direction": "upper(direction[1]) || lower(direction[2:])",
    "pm_message_standard": "lower(pm_message_standard)",
    "reference":
        "['a' || chr(10) || 'b' || chr(9) || 'c', 'say \"hi\", twice', 'null', '']"
        "[1 + event_id % 4]",
    "pm_raw_payload":
        "'{1:F01}' || chr(10) || '{4:' || chr(9) || account_id || ',' || direction || '}'",
    "pm_parsed_payload_json": "'{\"id\":\"' || transaction_id || '\"}'",
    "iso_parties_by_role_json": "CAST(NULL AS VARCHAR)",
    "screening_events_json": "screening_events_json",
    "geo_events_json": "geo_events_json",
    "orig_pep_flag": "CASE WHEN orig_pep_flag THEN 'True' ELSE 'FALSE' END",
    "orig_sanctions_flag": "CASE WHEN orig_sanctions_flag THEN 'True' ELSE 'FALSE' END",
    "ben_pep_flag": "['', 'UNKNOWN', '1'][1 + event_id % 3]",
    "ben_sanctions_flag": "CAST(NULL AS VARCHAR)",
    "orig_home_jurisdiction_id": "orig_home_jurisdiction_id",
    "ben_home_jurisdiction_id": "ben_home_jurisdiction_id",
    "orig_kyc_level": "orig_kyc_level",
    "acct_status": "acct_status",
    **{
        name: f"['true', 'FALSE', 'true ', '1', 'False'][1 + (event_id + {position}) % 5]"
        for position, name in enumerate(DELETED_COLUMNS)
    },
    **{
        name: time_text(position)
        for position, name in enumerate(TIMESTAMP_COLUMNS)
        if position
    },
    "acct_created_ts": "strftime(acct_created_ts_ts, '%Y-%m-%d %H:%M:%S')",
}


def no_token(value: str) -> str:
    return f"CASE WHEN trim({value}) NOT IN ('UNKNOWN','NULL','null','N/A','na','') THEN {value} END"


RAW = "raw AS (SELECT event_id, " + ", ".join(
    f"{sql} AS {name}" for name, sql in RAW_COLUMNS.items()
) + f", {time_truth(0)} AS booking_truth, acct_created_ts_ts AS acct_created_truth FROM typed)"

_AMOUNT_TEXT = f"regexp_replace({no_token('amount')}, '[^0-9.-]', '', 'g')"
AMOUNTS = f"""
amounts AS (
  SELECT transaction_id, amount, {_AMOUNT_TEXT} AS amount_clean_str,
         TRY_CAST({_AMOUNT_TEXT} AS DECIMAL(18,2)) AS amount_num
  FROM raw
)"""


def truth_sql(value: str) -> str:
    return f"CASE upper({value}) WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END"


SILVER = f"""
silver AS (
  SELECT r.transaction_id, account_id,
         booking_truth AS booking_ts_ts, acct_created_truth AS acct_created_ts_ts,
         upper(trim(direction)) AS direction, upper(trim(transaction_type)) AS transaction_type,
         originator_party_id, acct_status, upper(trim(status)) AS status,
         upper(trim(channel)) AS channel,
         upper(trim(pm_message_standard)) AS pm_message_standard,
         {truth_sql('orig_pep_flag')} AS orig_pep_flag,
         {truth_sql('orig_sanctions_flag')} AS orig_sanctions_flag,
         CAST(NULL AS BOOLEAN) AS ben_pep_flag, CAST(NULL AS BOOLEAN) AS ben_sanctions_flag,
         screening_events_json, geo_events_json, orig_home_jurisdiction_id,
         ben_home_jurisdiction_id, orig_kyc_level,
         CAST(a.amount_num * coalesce(f.usd_rate, 1.0::DOUBLE) AS DECIMAL(18,2)) AS amount_usd
  FROM raw r
  JOIN amounts a ON a.transaction_id = r.transaction_id
  LEFT JOIN rates f ON f.currency_code = upper(trim(r.currency_code))
)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


TX = ctes(TYPED)
TX_GOLD = ctes(TYPED, GOLD.format(source="typed"))
TX_ALERTS = ctes(TYPED, GOLD.format(source="typed"), ALERTS)
TX_RAW = ctes(TYPED, RAW)
TX_AMOUNTS = ctes(TYPED, RAW, AMOUNTS)
PIPELINE = ctes(TYPED, RAW, AMOUNTS, RATES, SILVER, GOLD.format(source="silver"), ALERTS)

_HELPERS = "booking_date, is_cash_credit, is_wire_debit, is_cross_border, screening_text, geo_text"
_ALERT_COLUMNS = (
    "transaction_id, account_id, amount_usd, booking_ts, alert_type, alert_reason, tx_risk_score"
)
_TOP = (
    "transaction_id, account_id, amount_usd, booking_ts_ts, risk_score_simple, flag_structuring, "
    "flag_smurfing, flag_placement, flag_layering_pass_through, flag_sanctions_hit, flag_pep, "
    "flag_high_value_cross_border, flag_kyc_gap, flag_dormant_account_activity, "
    "flag_high_risk_geo, flag_round_dollar"
)
_FLAGS = [flag for _, flag, _ in ALERT_RULES]
_TEXTS = (
    "reference", "pm_raw_payload", "pm_parsed_payload_json",
    "iso_parties_by_role_json", "screening_events_json", "geo_events_json",
)
_CODES = (
    "currency_code", "direction", "channel", "status", "transaction_type",
    "source_system", "acct_currency_code", "pm_direction", "pm_message_standard",
)
_BOOLEANS = ("orig_pep_flag", "orig_sanctions_flag", "ben_pep_flag", "ben_sanctions_flag",
             *DELETED_COLUMNS)
_NORMALIZED = """nullif(trim(regexp_replace(regexp_replace(replace(regexp_replace(
    trim(booking_ts), 'UTC|GMT', '', 'g'), '_', ' '), '([0-9])[Tt]([0-9])', '\\1 \\2', 'g'),
    '[Zz]$', '')), '')"""
HIGHEST_SCORE = 27


def _counts(relation: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM {relation} GROUP BY {column}"


def oracle_sql() -> dict[str, str]:
    every_null = [f"CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS {c}" for c in (
        "transaction_id", "account_id", "amount", "currency_code", "direction",
        "transaction_type", "booking_ts")]
    cells = ", ".join(
        f'coalesce(sum(count) FILTER (tx_risk_score = {s}), 0)::BIGINT AS "{s}"'
        for s in range(HIGHEST_SCORE + 1)
    )
    per_cell = "SELECT alert_type, tx_risk_score, count(*) AS count FROM alerts GROUP BY ALL"
    grid = f"""
      SELECT t.alert_type, CAST(x.score AS INTEGER) AS tx_risk_score,
             CAST(coalesce(c.count, 0) AS BIGINT) AS count,
             CASE WHEN c.count IS NULL THEN 0.1::DOUBLE ELSE CAST(c.count AS DOUBLE) END
               AS count_for_color
      FROM (SELECT DISTINCT alert_type FROM alerts) t
      CROSS JOIN (SELECT unnest(range(lo, hi + 1)) AS score FROM (
        SELECT min(tx_risk_score) AS lo, max(tx_risk_score) AS hi FROM alerts)) x
      LEFT JOIN ({per_cell}) c ON c.alert_type = t.alert_type AND c.tx_risk_score = x.score"""
    booking_mark = "CAST(booking_truth IS NULL AS INTEGER)"
    amount_mark = "CAST(amount_num IS NULL OR amount_num < 0 AS INTEGER)"
    sql = {
        # sources, sinks, layers
        "csv_roundtrip": TX_RAW + "SELECT " + ", ".join(
            f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS) + " FROM raw",
        "bronze_lineage": """SELECT count(*) AS rows, count(*) AS stamped, count(*) AS from_csv,
            CAST(1 AS BIGINT) AS ingest_times FROM events""",
        "write_read_back": TX_ALERTS + f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "layer_counts": PIPELINE + """
            SELECT 'bronze' AS layer, count(*) AS rows FROM raw
            UNION ALL SELECT 'silver', count(*) FROM silver
            UNION ALL SELECT 'gold', count(*) FROM gold
            UNION ALL SELECT 'alerts', count(*) FROM alerts""",
        "layer_listing": PIPELINE + """
            SELECT 'transactions_gold' AS "tableName", count(*) AS rows FROM gold
            UNION ALL SELECT 'tx_alerts_gold', count(*) FROM alerts""",
        "pipeline_alerts": PIPELINE + f"SELECT {_ALERT_COLUMNS} FROM alerts",
        "fx_rates": ctes(RATES) + "SELECT * FROM rates",
        "fx_needed_rates": ctes(TYPED, RATES) + """
            SELECT * FROM rates WHERE currency_code IN (SELECT currency_code FROM typed)""",
        "fx_convert": ctes(TYPED, RATES) + """
            SELECT t.currency_code, transaction_id, coalesce(usd_rate, 1.0::DOUBLE) AS usd_rate,
                   CAST(t.amount_usd * coalesce(usd_rate, 1.0::DOUBLE) AS DECIMAL(18,2))
                     AS amount_usd,
                   CAST(usd_rate IS NULL AS INTEGER) AS dq_fx_missing
            FROM typed t LEFT JOIN rates r ON r.currency_code = t.currency_code""",
        # cleaning
        "clean_null_tokens": TX_RAW + "SELECT " + ", ".join(
            f"{no_token(c)} AS {c}" for c in RAW_COLUMNS) + " FROM raw",
        "clean_scrub_text": TX_RAW + "SELECT transaction_id, " + ", ".join(
            f"translate({c}, chr(13) || chr(10) || chr(9), '   ') AS {c}" for c in _TEXTS)
            + " FROM raw",
        "clean_codes": TX_RAW + "SELECT transaction_id, " + ", ".join(
            f"upper(trim({c})) AS {c}" for c in _CODES) + " FROM raw",
        "clean_booleans": TX_RAW + "SELECT transaction_id, " + ", ".join(
            f"{truth_sql(c)} AS {c}" for c in _BOOLEANS) + " FROM raw",
        "clean_amount": TX_AMOUNTS + f"""
            SELECT transaction_id, amount, amount_clean_str, amount_num,
                   {amount_mark} AS dq_amount_invalid FROM amounts""".replace(
                       "transaction_id, amount,", f"transaction_id, {no_token('amount')} AS amount,"),
        "ts_normalize": TX_RAW + f"""
            SELECT transaction_id, booking_ts,
                   CASE WHEN booking_ts = '2.02601E+13' THEN '20260100000000'
                        ELSE {_NORMALIZED} END AS __norm_booking_ts FROM raw""",
        "ts_parse": TX_RAW + f"""
            SELECT transaction_id, booking_ts, booking_truth AS booking_ts_ts,
                   {booking_mark} AS dq_booking_ts_unparsed FROM raw""",
        "ts_parse_all": TX + "SELECT transaction_id, " + ", ".join(
            f"{'acct_created_ts_ts' if c == 'acct_created_ts' else time_truth(i)} AS {c}_ts"
            for i, c in enumerate(TIMESTAMP_COLUMNS))
            + f", CAST(({time_truth(0)}) IS NULL AS INTEGER) AS dq_booking_ts_unparsed FROM typed",
        # quality
        "null_profile": TX_RAW + f"SELECT {', '.join(every_null)} FROM raw",
        "dq_booking_summary": TX_RAW + """
            SELECT CASE WHEN booking_truth IS NULL THEN 'Unparsed booking_ts'
                   ELSE 'Parsed booking_ts' END AS status, count(*) AS count FROM raw GROUP BY 1""",
        "dq_booking_labels": TX_RAW + f"""
            SELECT {booking_mark} AS dq_booking_ts_unparsed, count(*) AS count,
                   CASE WHEN booking_truth IS NULL THEN 'Unparsed' ELSE 'Parsed' END AS label
            FROM raw GROUP BY 1, 3""",
        "dq_amount_summary": TX_AMOUNTS + f"""
            SELECT CASE WHEN {amount_mark} = 1 THEN 'Invalid amount' ELSE 'Valid amount' END
                   AS status, count(*) AS count FROM amounts GROUP BY 1""",
        "dq_amount_labels": TX_AMOUNTS + f"""
            SELECT {amount_mark} AS dq_amount_invalid, count(*) AS count,
                   CASE WHEN {amount_mark} = 1 THEN 'Invalid Amount' ELSE 'Valid Amount' END
                     AS status FROM amounts GROUP BY 1, 3""",
        "unparsed_preview": TX_RAW + f"""
            SELECT transaction_id, booking_ts,
                   CASE WHEN booking_ts = '2.02601E+13' THEN '20260100000000'
                        ELSE {_NORMALIZED} END AS __norm_booking_ts,
                   booking_truth AS booking_ts_ts, {booking_mark} AS dq_booking_ts_unparsed
            FROM raw ORDER BY 5 DESC, transaction_id LIMIT 50""",
        # gold
        "gold_helpers": TX_GOLD + f"SELECT transaction_id, {_HELPERS} FROM helped",
        "near_threshold_daily": TX_GOLD + "SELECT * FROM near",
        "near_threshold_features": TX_GOLD + """
            SELECT account_id, booking_date, transaction_id, near_thr_cash_cnt,
                   near_thr_cash_sum_usd, near_thr_cash_dist_depositors FROM featured""",
        "prev24h_credit": TX_GOLD + """
            SELECT transaction_id, account_id, ts_sec, prev24h_credit_sum_usd FROM featured""",
        "rapid_sequence": TX_GOLD + """
            SELECT transaction_id, account_id, ts_sec, rapid_seq_txn_cnt FROM featured""",
        "risk_score": TX_GOLD + "SELECT transaction_id, risk_score_simple FROM gold",
        # alerts and reports
        "alerts_long": TX_ALERTS + """
            SELECT transaction_id, account_id, amount_usd, booking_ts, alert_type, tx_risk_score
            FROM alerts""",
        "alert_reasons": TX_ALERTS + "SELECT transaction_id, alert_type, alert_reason FROM alerts",
        "tx_has_alert": TX_ALERTS + """
            SELECT transaction_id, amount_usd, risk_score_simple, transaction_type,
                   CAST(transaction_id IN (SELECT transaction_id FROM alerts) AS INTEGER)
                     AS has_alert FROM gold""",
        "flag_totals": TX_GOLD + "SELECT " + ", ".join(
            f"CAST(sum(CAST({f} AS INTEGER)) AS BIGINT) AS {f}" for f in _FLAGS) + " FROM gold",
        "top_risk_transactions": TX_GOLD + f"""
            SELECT {_TOP} FROM gold ORDER BY risk_score_simple DESC, transaction_id LIMIT 100""",
        "top_risk_transactions_full": TX_GOLD + """
            SELECT * EXCLUDE (geo_touch) FROM gold
            ORDER BY risk_score_simple DESC, transaction_id LIMIT 100""",
        "alert_type_counts": TX_ALERTS + _counts("alerts", "alert_type"),
        "account_day_drilldown": TX_GOLD + """
            SELECT transaction_id, account_id, amount_usd, transaction_type, direction,
                   near_thr_cash_cnt, near_thr_cash_dist_depositors, flag_structuring,
                   flag_smurfing
            FROM gold WHERE account_id = 'A7' AND booking_date = DATE '2024-01-05'""",
        "tx_type_mix": TX_GOLD + _counts("gold", "transaction_type"),
        "channel_mix": TX_GOLD + _counts("gold", "channel"),
        "daily_trend": TX_GOLD + """
            SELECT booking_date, count(*) AS tx_count,
                   CAST(sum(amount_usd) AS DECIMAL(28,2)) AS total_usd FROM gold GROUP BY 1""",
        "near_threshold_daily_rowsum": TX_GOLD + """
            SELECT booking_date, CAST(sum(near_thr_cash_cnt) AS BIGINT) AS near_thr_cash_cnt_total,
                   CAST(sum(near_thr_cash_sum_usd) AS DECIMAL(38,2)) AS near_thr_cash_sum_usd_total
            FROM gold GROUP BY 1""",
        "risk_distribution": TX_GOLD + _counts("gold", "risk_score_simple"),
        "alert_risk_counts": TX_ALERTS + per_cell,
        "top_accounts": TX_GOLD + """
            SELECT account_id, CAST(sum(risk_score_simple) AS BIGINT) AS total_risk,
                   count(*) AS tx_count, CAST(sum(amount_usd) AS DECIMAL(28,2)) AS total_usd
            FROM gold GROUP BY 1 ORDER BY total_risk DESC, account_id LIMIT 15""",
        "amount_values": TX_GOLD + """
            SELECT CAST(amount_usd AS DOUBLE) AS amount_usd FROM gold
            WHERE amount_usd IS NOT NULL""",
        "amount_histogram": TX_GOLD + """
            SELECT CAST(sign(amount_usd) AS INTEGER) AS sign,
                   CASE WHEN amount_usd <> 0
                     THEN CAST(floor(round(log10(abs(CAST(amount_usd AS DOUBLE))) * 10, 9)) AS INTEGER)
                   END AS bin,
                   count(*) AS count
            FROM gold WHERE amount_usd IS NOT NULL GROUP BY ALL""",
        "report_overview": TX_ALERTS + " UNION ALL ".join(
            f"SELECT '{key}' AS report, CAST({key} AS VARCHAR) AS key, count(*) AS count "
            f"FROM {table} GROUP BY ALL"
            for table, key in (
                ("gold", "transaction_type"), ("gold", "channel"), ("gold", "risk_score_simple"),
                ("gold", "booking_date"), ("alerts", "alert_type"),
            )),
        "alert_risk_grid": TX_ALERTS + grid,
        "alert_risk_pivot": TX_ALERTS + f"""
            SELECT alert_type, {cells} FROM ({per_cell}) GROUP BY alert_type""",
    }
    sql |= {flag: TX_GOLD + f"SELECT transaction_id, {flag} FROM gold" for flag in _FLAGS}
    return sql
