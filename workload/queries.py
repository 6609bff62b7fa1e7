"""Every operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.config import (
    CODE_COLUMNS,
    CORE_COLUMNS,
    DELETED_COLUMNS,
    TEXT_COLUMNS,
    TIMESTAMP_COLUMNS,
)
from txmon.operators import clean, features, fx, quality, rules
from txmon.operators.alerts import has_alert, to_alerts
from txmon.plans import pipeline, reports
from txmon.plans.overview import Overview
from txmon.session import configure, scratch_dir
from txmon.sources import files, layers, rates, split_csv
from workload.transactions import quotes, raw_transactions, transactions

PARTY_FLAGS = ("orig_pep_flag", "orig_sanctions_flag", "ben_pep_flag", "ben_sanctions_flag")

Query = Callable[[SparkSession, str], DataFrame]


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.gold(transactions(spark, sf_dir))


_stored: dict[tuple[str, str], str] = {}


def _stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as a run stores it, by day and account; written once a session and reread."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        root = scratch_dir(spark, "gold")
        prefix = "stored_" + root.rsplit("-", 1)[-1] + "_"
        layers.ensure_layers(spark, prefix, root)
        layers.write_layer(
            _gold(spark, sf_dir),
            "gold",
            pipeline.GOLD_TABLE,
            prefix,
            partition_by=["booking_date"],
            cluster_by=["account_id"],
        )
        _stored[key] = prefix
    return layers.read_layer(spark, "gold", pipeline.GOLD_TABLE, _stored[key])


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_alerts(_stored_gold(spark, sf_dir))


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.fx_rates(quotes(spark, sf_dir))


def _raw_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "raw-csv")
    raw = raw_transactions(spark, sf_dir, spread=True)
    files.write_raw_csv(raw, path, records_per_file=10_000)
    return path


def _run(spark: SparkSession, sf_dir: str) -> tuple[str, pipeline.Layers]:
    """The prefix of the layers' schemas, and the layers; the raw files are no longer needed then."""
    root = scratch_dir(spark, "layers")
    prefix = "run_" + root.rsplit("-", 1)[-1] + "_"
    raw = _raw_file(spark, sf_dir)
    made = pipeline.run(spark, raw, _rates(spark, sf_dir), prefix, root, keep_raw=False)
    return prefix, made


# --- sources, sinks, layers ---


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the records in files with the columns in reverse and one more."""
    raw = raw_transactions(spark, sf_dir)
    odd = F.substring("transaction_id", 2, 20).cast("long") % 2 == 1
    folders = [scratch_dir(spark, "raw-csv"), scratch_dir(spark, "raw-csv-other")]
    files.write_raw_csv(raw.where(~odd), folders[0], records_per_file=10_000)
    other = raw.where(odd).select(*reversed(raw.columns), F.lit("x").alias("one_more"))
    files.write_raw_csv(other, folders[1], records_per_file=10_000)
    return split_csv.read_split_csv(spark, folders, raw.columns).drop("_source_file")


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = pipeline.bronze(split_csv.read_split_csv(spark, _raw_file(spark, sf_dir)))
    return bronze.agg(
        F.count("*").alias("rows"),
        F.count("_ingest_ts").alias("stamped"),
        F.count_if(F.col("_source_file").endswith(".csv")).alias("from_csv"),
        F.countDistinct("_ingest_ts").alias("ingest_times"),
    )


def write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "layers")
    prefix = "back_" + root.rsplit("-", 1)[-1] + "_"
    layers.ensure_layers(spark, prefix, root)
    gold = layers.write_layer(_gold(spark, sf_dir), "gold", pipeline.GOLD_TABLE, prefix)
    layers.write_layer(to_alerts(gold), "gold", pipeline.ALERTS_TABLE, prefix)
    return layers.read_layer(spark, "gold", pipeline.ALERTS_TABLE, prefix)


def layer_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the gold layer after a run, with their rows."""
    prefix, _ = _run(spark, sf_dir)
    listed = layers.list_layer(spark, "gold", prefix)
    names = [r["tableName"] for r in listed.collect()]  # a handful of tables
    tables = {name: layers.read_layer(spark, "gold", name, prefix) for name in names}
    counts = quality.layer_counts(**tables).withColumnRenamed("layer", "tableName")
    return listed.join(counts, "tableName").select("tableName", "rows")


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the layers were written."""
    return quality.observed_counts(spark, _run(spark, sf_dir)[1].observed)


def pipeline_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1].alerts


def fx_needed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.needed_rates(transactions(spark, sf_dir), _rates(spark, sf_dir))


def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).withColumnRenamed("amount_usd", "amount_num")
    return fx.convert_to_usd(tx, _rates(spark, sf_dir)).select(
        "currency_code", "transaction_id", "usd_rate", "amount_usd", "dq_fx_missing"
    )


# --- cleaning ---


def clean_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.null_tokens(raw_transactions(spark, sf_dir))


def clean_scrub_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.scrub_text(raw_transactions(spark, sf_dir, ["transaction_id", *TEXT_COLUMNS]))


def clean_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalize_codes(
        raw_transactions(spark, sf_dir, ["transaction_id", *CODE_COLUMNS])
    )


def clean_booleans(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["transaction_id", *PARTY_FLAGS, *DELETED_COLUMNS]
    return clean.parse_booleans(raw_transactions(spark, sf_dir, columns))


def clean_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir, ["transaction_id", "amount"])
    return clean.clean_amount(clean.null_tokens(raw))


def _parsed_booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_timestamps(
        raw_transactions(spark, sf_dir, ["transaction_id", "booking_ts"])
    )


def ts_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_booking(spark, sf_dir).select(
        "transaction_id", "booking_ts", "__norm_booking_ts"
    )


def ts_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_booking(spark, sf_dir).drop("__norm_booking_ts")


def _stored_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw texts of all timestamp columns, written once a session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} times")
    if key not in _stored:
        path = scratch_dir(spark, "raw-times")
        raw = raw_transactions(spark, sf_dir, ["transaction_id", *TIMESTAMP_COLUMNS])
        # The test tables are single files; several written ones let the parse use all cores.
        raw.write.option("maxRecordsPerFile", 10_000).parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def ts_parse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_timestamps(_stored_times(spark, sf_dir)).select(
        "transaction_id", *(f"{c}_ts" for c in TIMESTAMP_COLUMNS), "dq_booking_ts_unparsed"
    )


# --- features, rules, alerts ---


def gold_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_gold_helpers(transactions(spark, sf_dir)).select(
        "transaction_id",
        "booking_date",
        "is_cash_credit",
        "is_wire_debit",
        "is_cross_border",
        "screening_text",
        "geo_text",
    )


def near_threshold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_near_threshold(transactions(spark, sf_dir)).select(
        "account_id",
        "booking_date",
        "transaction_id",
        "near_thr_cash_cnt",
        "near_thr_cash_sum_usd",
        "near_thr_cash_dist_depositors",
    )


def prev24h_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_prev_credit(transactions(spark, sf_dir)).select(
        "transaction_id", "account_id", "ts_sec", "prev24h_credit_sum_usd"
    )


def rapid_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_rapid_sequence(transactions(spark, sf_dir)).select(
        "transaction_id", "account_id", "ts_sec", "rapid_seq_txn_cnt"
    )


def _gold_columns(*columns: str) -> Query:
    return lambda spark, sf_dir: _stored_gold(spark, sf_dir).select("transaction_id", *columns)


def tx_has_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _stored_gold(spark, sf_dir)
    return has_alert(gold, to_alerts(gold))


def _on_gold(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_stored_gold(spark, sf_dir))


def _on_alerts(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_alerts(spark, sf_dir))


def _on_booking(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_parsed_booking(spark, sf_dir))


def _on_amounts(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(clean_amount(spark, sf_dir))


def _drilldown(gold: DataFrame) -> DataFrame:
    return reports.account_day_drilldown(gold, "A7", dt.date(2024, 1, 5))


def _pinned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "csv_roundtrip": csv_roundtrip,
        "bronze_lineage": bronze_lineage,
        "write_read_back": write_read_back,
        "layer_listing": layer_listing,
        "layer_counts": layer_counts,
        "pipeline_alerts": pipeline_alerts,
        "fx_rates": _rates,
        "fx_needed_rates": fx_needed_rates,
        "fx_convert": fx_convert,
        "clean_null_tokens": clean_null_tokens,
        "clean_scrub_text": clean_scrub_text,
        "clean_codes": clean_codes,
        "clean_booleans": clean_booleans,
        "clean_amount": clean_amount,
        "ts_normalize": ts_normalize,
        "ts_parse": ts_parse,
        "ts_parse_all": ts_parse_all,
        "null_profile": lambda s, d: quality.null_profile(raw_transactions(s, d, CORE_COLUMNS)),
        "dq_booking_summary": _on_booking(quality.booking_status),
        "dq_booking_labels": _on_booking(quality.booking_quality),
        "dq_amount_summary": _on_amounts(quality.amount_status),
        "dq_amount_labels": _on_amounts(quality.amount_quality),
        "unparsed_preview": _on_booking(quality.unparsed_preview),
        "gold_helpers": gold_helpers,
        "near_threshold_daily": lambda s, d: features.near_threshold_daily(transactions(s, d)),
        "near_threshold_features": near_threshold_features,
        "prev24h_credit": prev24h_credit,
        "rapid_sequence": rapid_sequence,
        **{flag: _gold_columns(flag) for flag in rules.FLAGS},
        "risk_score": _gold_columns("risk_score_simple"),
        "alerts_long": lambda s, d: _alerts(s, d).drop("alert_reason"),
        "alert_reasons": lambda s, d: _alerts(s, d).select(
            "transaction_id", "alert_type", "alert_reason"
        ),
        "tx_has_alert": tx_has_alert,
        "flag_totals": _on_gold(reports.flag_totals),
        "top_risk_transactions": _on_gold(reports.top_risk_transactions),
        "top_risk_transactions_full": _on_gold(
            lambda gold: reports.top_risk_transactions(gold, columns=None)
        ),
        "alert_type_counts": _on_alerts(reports.alert_type_counts),
        "account_day_drilldown": _on_gold(_drilldown),
        "tx_type_mix": _on_gold(reports.tx_type_mix),
        "channel_mix": _on_gold(reports.channel_mix),
        "daily_trend": _on_gold(reports.daily_trend),
        "near_threshold_daily_rowsum": _on_gold(reports.near_threshold_daily_rowsum),
        "risk_distribution": _on_gold(reports.risk_distribution),
        "alert_risk_counts": _on_alerts(reports.alert_risk_counts),
        "top_accounts": _on_gold(reports.top_accounts),
        "amount_values": _on_gold(reports.amount_values),
        "amount_histogram": _on_gold(
            lambda gold: reports.amount_histogram(gold).select("sign", "bin", "count")
        ),
        "report_overview": _on_gold(lambda gold: Overview.of(gold).long()),
        "alert_risk_grid": _on_alerts(reports.alert_risk_grid),
        "alert_risk_pivot": _on_alerts(reports.alert_risk_pivot),
    }
    return {name: _pinned(query) for name, query in found.items()}
