"""The plans and the hot keys: what must hold when the data no longer fits a machine."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from txmon.operators import features, fx
from txmon.operators.alerts import has_alert
from txmon.plans import pipeline, reports
from txmon.sources.rates import fx_rates
from workload.queries import queries
from workload.transactions import quotes, transactions

SF = "/root/testdata/sf0.001"
WRITING = {"csv_roundtrip", "bronze_lineage", "write_read_back", "layer_listing", "layer_counts",
           "pipeline_alerts", "ts_parse_all", "tx_has_alert"}


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


def scans(df, line):
    return re.findall(rf"^{line}: (.*)$", plan(df, "formatted"), re.MULTILINE)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """One account has two thirds of the rows, half of them without a time."""
    path = str(tmp_path_factory.mktemp("hot") / "tx")
    n = F.col("id")
    spark.range(0, 300_000, 1, 8).select(
        n.cast("string").alias("transaction_id"),
        F.when(n % 3 < 2, "hot").otherwise(F.concat(F.lit("A"), n % 5000)).alias("account_id"),
        F.when(n % 3 != 1, F.timestamp_seconds(n % 400_000 + 1_700_000_000)).alias("booking_ts_ts"),
        ((n % 1000) * 13).cast("decimal(18,2)").alias("amount_usd"),
        F.when(n % 2 == 0, "CREDIT").otherwise("DEBIT").alias("direction"),
        F.when(n % 4 < 2, "CASH").otherwise("WIRE").alias("transaction_type"),
        F.concat(F.lit("P"), n % 97).alias("originator_party_id"),
        F.repeat(F.lit("x"), 100).alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_queries_plan_without_cross_joins_or_python(spark):
    for name, query in queries().items():
        if name not in WRITING:
            text = plan(query(spark, SF))
            for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
                assert bad not in text, name


def test_transactions_are_shuffled_once(spark, settings, hot):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = features.with_account_features(hot)
    text = plan(df)
    exchanges = re.findall(r"Exchange hashpartitioning\((.*)", text)
    wide = [line for line in exchanges if line.startswith("coalesce(account_id")]
    # The transactions move once; everything else that moves is pre-aggregated.
    assert len(wide) == 1
    assert sum("payload" in schema for schema in scans(df, "ReadSchema")) == 1
    assert text.count("HashAggregate") >= 2 * (len(exchanges) - 4)


@pytest.fixture
def small_partitions(settings):
    """What counts as hot on a cluster, scaled down; and no broadcast instead of a shuffle."""
    settings(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        }
    )


def test_hot_account_is_split(small_partitions, hot):
    df = features.with_account_features(hot)
    total = df.agg(F.count("*"), F.max("rapid_seq_txn_cnt"), F.sum(F.length("payload")))
    # Every transaction of the hot account without a time sees all of them.
    assert tuple(total.first()) == (300_000, 100_000, 300_000 * 100)
    total.collect()
    assert "SortMergeJoin(skew=true)" in plan(total)


def test_hot_account_day_is_split(small_partitions, hot):
    df = hot.withColumn("booking_ts_ts", F.lit(dt.datetime(2026, 1, 1)))
    joined = features.with_near_threshold(df)
    total = joined.agg(F.count("*"), F.max("near_thr_cash_cnt"), F.sum(F.length("payload")))
    assert total.first()[0] == 300_000
    total.collect()
    assert "SortMergeJoin(skew=true)" in plan(total)


@pytest.mark.parametrize("shared", ["T0", None])
def test_hot_transaction_id_is_split(small_partitions, hot, shared):
    n = F.col("transaction_id").cast("int")
    gold = hot.select(
        F.when(n % 3 == 0, F.lit(shared))
        .otherwise(F.col("transaction_id"))
        .alias("transaction_id"),
        "amount_usd",
        F.lit(1).alias("risk_score_simple"),
        F.sha2("payload", 256).alias("transaction_type"),
    )
    alerts = gold.where("amount_usd < 6500").select("transaction_id")
    marked = has_alert(gold, alerts)
    total = marked.agg(F.count("*"), F.sum("has_alert"), F.max("transaction_type"))
    half = 100_000 if shared is None else 200_000
    assert tuple(total.first())[:2] == (300_000, half)
    total.collect()
    assert "SortMergeJoin(skew=true)" in plan(total)


def test_hot_currency_is_split_with_many_rates(small_partitions, hot):
    n = F.col("transaction_id").cast("int")
    code = F.when(n % 3 == 0, F.lit("USD")).otherwise(F.concat(F.lit("C"), n % 5000))
    tx = hot.withColumn("currency_code", code).withColumnRenamed("amount_usd", "amount_num")
    codes = tx.groupBy("currency_code").agg(F.lit(2.0).alias("usd_rate"))
    converted = fx.convert_to_usd(tx, codes, many_rates=True)
    total = converted.agg(F.count("*"), F.sum("dq_fx_missing"), F.sum(F.length("payload")))
    assert tuple(total.first())[:2] == (300_000, 0)
    total.collect()
    assert "SortMergeJoin(skew=true)" in plan(total)


def test_conversion_plans_without_a_job_and_reads_the_quotes_once(spark):
    tracker = spark.sparkContext.statusTracker()
    tx = transactions(spark, SF).withColumnRenamed("amount_usd", "amount_num")
    rates = fx_rates(quotes(spark, SF))
    spark.sparkContext.setJobGroup("planning", "")
    try:
        text = plan(fx.convert_to_usd(tx, rates))
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert text.count("events.parquet") == 2  # the transactions, the quotes


def test_window_partitions_are_bounded(spark, hot):
    """No window partition has more rows than a block and its surroundings have seconds."""
    sums = features._per_second(hot)
    assert sums.count() < hot.count() * 3 / 4
    per_block = sums.groupBy("account_id", F.floor(F.col("ts_sec") / (7 * 86400))).count()
    assert per_block.agg(F.max("count")).first()[0] <= 7 * 86400


def test_drilldown_reaches_the_scan(spark, tmp_path):
    pipeline.gold(transactions(spark, SF)).write.parquet(str(tmp_path / "gold"))
    gold = spark.read.parquet(str(tmp_path / "gold"))
    report = reports.account_day_drilldown(gold, "A7", dt.date(2024, 1, 5))
    (pushed,) = scans(report, "PushedFilters")
    assert "EqualTo(account_id,A7)" in pushed
    assert "GreaterThanOrEqual(booking_ts_ts" in pushed and "LessThan(booking_ts_ts" in pushed
    assert "screening_events_json" not in scans(report, "ReadSchema")[0]


def test_drilldown_reads_one_day_however_many_there_are(spark, tmp_path):
    from txmon.sources import layers

    gold = pipeline.gold(transactions(spark, SF))
    layers.ensure_layers(spark, "day_", str(tmp_path))
    read = []
    for last in (dt.date(2024, 1, 8), None):
        some = gold if last is None else gold.where(F.col("booking_date") <= F.lit(last))
        table = layers.write_layer(
            some, "gold", "g", "day_", partition_by=["booking_date"], cluster_by=["account_id"]
        )
        report = reports.account_day_drilldown(table, "A7", dt.date(2024, 1, 5))
        (partitions,) = scans(report, "PartitionFilters")
        assert "= 2024-01-05" in partitions
        (pushed,) = scans(report, "PushedFilters")
        assert "EqualTo(account_id,A7)" in pushed
        day = table.where(F.col("booking_date") == F.lit(dt.date(2024, 1, 5)))
        read.append(len(list(tmp_path.glob("day_gold/g/*/booking_date=2024-01-05/*.parquet"))))
        rows = day.select("account_id").collect()
        assert [r[0] for r in rows] == sorted(r[0] for r in rows)
        report.collect()
        assert report.count() == gold.where(
            "account_id = 'A7' AND booking_date = DATE'2024-01-05'"
        ).count()
    # One file in the version of a few days, and one in that of all.
    assert read == [1, 2]


def test_near_threshold_filter_reaches_the_scan(spark, hot):
    (pushed,) = scans(features.near_threshold_daily(hot), "PushedFilters")
    for part in ("EqualTo(direction,CREDIT)", "EqualTo(transaction_type,CASH)", "amount_usd"):
        assert part in pushed


def test_alerts_need_no_shuffle(spark, tmp_path):
    pipeline.gold(transactions(spark, SF)).write.parquet(str(tmp_path / "gold"))
    gold = spark.read.parquet(str(tmp_path / "gold"))
    assert "Exchange" not in plan(pipeline.alerts(gold))
