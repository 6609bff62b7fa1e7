"""The test tables seen as payment transactions (FIXTURES.md, sections 3 and 4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.config import CORE_COLUMNS, DELETED_COLUMNS, TIMESTAMP_COLUMNS

# --- fixed values of the mapping ---
COUNTRIES = ("US", "GB", "DE", "FR", "IN", "SG", "RU", "AE", "IR", "SY")
CHANNELS = ("ONLINE", "BRANCH", "ATM", "MOBILE")
CURRENCIES = ("USD", "EUR", "GBP", "INR", "JPY", "XXX", None)
QUOTES = (
    ("USD", 1.0), ("EUR", 0.8), ("GBP", 0.625), ("INR", 80.0),
    ("JPY", 100.0), ("BAD", 0.0), ("NEG", -1.0), (" chf ", 0.5),
)
ORIGINATORS = 97

# Layouts of booking times in raw files, then the values that are none.
RENDERED = (
    "dd-MM-yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy",
    "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy",
    "MMM dd yyyy HH:mm:ss", "MMM-dd-yyyy HH:mm:ss",
    "yyyy.MM.dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm",
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm",
    "yyyyMMdd", "yyyyMMdd HHmmss", "yyyyMMdd HHmm",
    "yyyy-DDD HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+05:30'", "yyyy-MM-dd'_'HH:mm:ss 'UTC'",
)
NOT_TIMES = ("UNKNOWN", "45:00.0", "2.02601E+13", "31-02-2026", None)
VARIANTS = len(RENDERED) + len(NOT_TIMES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple, index: Column) -> Column:
    """``values[index]``; the arrays are a handful of literals."""
    return F.get(F.array(*(F.lit(v) for v in values)), index.cast("int"))


def transactions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Typed transactions, one per event.

    A task reads whole row groups, and a table may have few. ``spread`` deals the narrow
    events to more tasks, for what makes much of each, each a range of them as they arrived.
    """
    event = F.col("event_id")
    # Every fifth user has an account of their own, the others share 20 hot ones.
    user = F.when(F.col("user_id") % 5 == 0, F.col("user_id")).otherwise(F.col("user_id") % 20)
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    originators = (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("__orig"),
            _pick(COUNTRIES, F.col("c_nationkey") % 10).alias("orig_home_jurisdiction_id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "SIMPLIFIED")
            .when(F.col("c_mktsegment") == "AUTOMOBILE", "ENHANCED")
            .otherwise("STANDARD")
            .alias("orig_kyc_level"),
        )
        .dropDuplicates(["__orig"])
    )
    beneficiaries = (
        table(spark, sf_dir, "supplier")
        .select(
            F.col("s_suppkey").alias("__ben"),
            _pick(COUNTRIES, F.col("s_nationkey") % 10).alias("ben_home_jurisdiction_id"),
        )
        .dropDuplicates(["__ben"])
    )
    events = table(spark, sf_dir, "events")
    if spread:
        tasks = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")),
            spark.sparkContext.defaultParallelism,
        )
        events = events.repartitionByRange(tasks, "event_id")
    typed = events.select(
        F.concat(F.lit("T"), event).alias("transaction_id"),
        F.concat(F.lit("A"), user).alias("account_id"),
        F.col("ts").cast("timestamp").alias("booking_ts_ts"),
        F.round(F.col("value") * 400, 2).cast("decimal(18,2)").alias("amount_usd"),
        F.when(kind.isin("click", "error"), "DEBIT").otherwise("CREDIT").alias("direction"),
        F.when(kind == "click", "WIRE")
        .when((kind == "error") & (event % 2 == 0), "ACH")
        .when(kind == "error", "SEPA")
        .when(kind == "purchase", "CARD")
        .otherwise("CASH")
        .alias("transaction_type"),
        F.concat(F.lit("P"), event % ORIGINATORS).alias("originator_party_id"),
        F.when(user % 10 == 0, "DORMANT").otherwise("ACTIVE").alias("acct_status"),
        F.when(event % 4 == 0, "PENDING").otherwise("POSTED").alias("status"),
        F.when(event % 3 == 0, "SWIFT_MT")
        .when(event % 3 == 1, "ISO20022_MX")
        .alias("pm_message_standard"),
        F.date_sub(F.lit("2024-01-01").cast("date"), (user * 3).cast("int"))
        .cast("timestamp")
        .alias("acct_created_ts_ts"),
        (event % ORIGINATORS % 31 == 0).alias("orig_pep_flag"),
        (event % ORIGINATORS % 41 == 0).alias("orig_sanctions_flag"),
        F.lit(None).cast("boolean").alias("ben_pep_flag"),
        F.lit(None).cast("boolean").alias("ben_sanctions_flag"),
        F.when(k < 3, '{"decision":"REJECT"}')
        .when(k < 8, '{"decision":"ESCALATE"}')
        .when(k < 10, '{"list":"PEP"}')
        .alias("screening_events_json"),
        F.when(k == 50, '{"type":"HIGH_RISK_GEO"}').alias("geo_events_json"),
        _pick(CHANNELS, event % 4).alias("channel"),
        _pick(CURRENCIES, event % 7).alias("currency_code"),
        event.alias("event_id"),
        F.expr("event_id * 3 div 20").alias("__orig"),
        F.expr("event_id div 100").alias("__ben"),
    )
    # Both sides grow with the data, so Spark chooses the join by their size; no key is hot.
    # Being unique by the key, a side drops out of queries that use none of its columns.
    return (
        typed.join(originators, "__orig", "left")
        .join(beneficiaries, "__ben", "left")
        .drop("__orig", "__ben")
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of exchange-rate quotes, one per event, each currency many times."""
    slot = F.col("event_id") % len(QUOTES)
    return table(spark, sf_dir, "events").select(
        _pick(tuple(c for c, _ in QUOTES), slot).alias("currency_code"),
        _pick(tuple(u for _, u in QUOTES), slot).alias("units_per_usd"),
    )


def rendered_time(instant: str, variant: str) -> Column:
    """The instant as raw text in one of the layouts, or a value that is no time."""
    arms = [f"""WHEN {i} THEN date_format({instant}, "{f}")""" for i, f in enumerate(RENDERED)]
    arms += [
        f"WHEN {i} THEN '{value}'"
        for i, value in enumerate(NOT_TIMES, start=len(RENDERED))
        if value is not None
    ]
    return F.expr(f"CASE {variant} {' '.join(arms)} END")


def time_variant(position: int) -> str:
    """Which layout column number ``position`` uses; column 0 is ``booking_ts``."""
    return f"(event_id + {5 * position}) % {VARIANTS}"


def raw_transactions(
    spark: SparkSession, sf_dir: str, wanted: Sequence[str] | None = None, spread: bool = False
) -> DataFrame:
    """The same transactions as a raw file would hold them: strings, untidy ones included."""
    tx = transactions(spark, sf_dir, spread)
    event = F.col("event_id")
    plain = F.col("amount_usd").cast("string")
    grouped = F.format_number("amount_usd", 2)
    amount = (
        F.when(event % 11 == 0, F.concat(F.lit("$"), grouped))
        .when(event % 11 == 1, F.concat(F.lit("("), grouped, F.lit(")")))
        .when(event % 11 == 2, F.concat(F.lit("-"), plain))
        .when(event % 11 == 3, F.concat(F.lit(" "), plain, F.lit(" USD")))
        .when(event % 11 == 4, F.concat(plain, F.lit("0")))
        .when(event % 110 == 5, "abc")
        .when(event % 110 == 16, "1.2.3")
        .when(event % 110 == 27, "N/A")
        .when(event % 110 == 38, "1.2E5")
        .when(event % 110 == 49, "1.005")
        .otherwise(plain)
    )
    truth = lambda flag: F.when(flag, "True").when(~flag, "FALSE")
    columns = {
        "transaction_id": F.col("transaction_id"),
        "account_id": F.col("account_id"),
        "amount": amount,
        "currency_code": F.concat(F.lit(" "), F.lower("currency_code")),
        "direction": F.when(event % 2 == 0, F.lower("direction")).otherwise(F.col("direction")),
        "transaction_type": F.concat(F.col("transaction_type"), F.lit(" ")),
        "originator_party_id": F.col("originator_party_id"),
        "counterparty_party_id": _pick(
            (" UNKNOWN ", "Unknown", "N/A", " x ", "na", "NA"), event % 6
        ),
        "channel": F.initcap("channel"),
        "status": F.lower("status"),
        "source_system": _pick(("core", " swift", "NULL"), event % 3),
        "acct_currency_code": F.lower("currency_code"),
        "pm_direction": F.initcap("direction"),
        "pm_message_standard": F.lower("pm_message_standard"),
        "reference": _pick(('a\nb\tc', 'say "hi", twice', "null", ""), event % 4),
        "pm_raw_payload": F.concat(F.lit("{1:F01}\n{4:\t"), F.col("props_free"), F.lit("}")),
        "pm_parsed_payload_json": F.concat(F.lit('{"id":"'), F.col("transaction_id"), F.lit('"}')),
        "iso_parties_by_role_json": F.lit(None).cast("string"),
        "screening_events_json": F.col("screening_events_json"),
        "geo_events_json": F.col("geo_events_json"),
        "orig_pep_flag": truth(F.col("orig_pep_flag")),
        "orig_sanctions_flag": truth(F.col("orig_sanctions_flag")),
        "ben_pep_flag": _pick(("", "UNKNOWN", "1"), event % 3),
        "ben_sanctions_flag": F.lit(None).cast("string"),
        "orig_home_jurisdiction_id": F.col("orig_home_jurisdiction_id"),
        "ben_home_jurisdiction_id": F.col("ben_home_jurisdiction_id"),
        "orig_kyc_level": F.col("orig_kyc_level"),
        "acct_status": F.col("acct_status"),
    }
    columns |= {
        name: _pick(("true", "FALSE", "true ", "1", "False"), (event + position) % 5)
        for position, name in enumerate(DELETED_COLUMNS)
    }
    columns |= {
        name: rendered_time("booking_ts_ts", time_variant(position))
        for position, name in enumerate(TIMESTAMP_COLUMNS)
        if wanted is None or name in wanted
    }
    # Account openings are plain, so that account ages are known.
    columns["acct_created_ts"] = F.date_format("acct_created_ts_ts", "yyyy-MM-dd HH:mm:ss")
    if wanted is None:
        wanted = [*CORE_COLUMNS, *(c for c in columns if c not in CORE_COLUMNS)]
    tx = tx.withColumn("props_free", F.concat_ws(",", "account_id", "direction"))
    return tx.select(*(columns[c].alias(c) for c in wanted))
