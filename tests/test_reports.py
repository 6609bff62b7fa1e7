from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txmon.operators import quality
from txmon.operators.alerts import to_alerts
from txmon.plans import pipeline, reports
from txmon.plans.overview import Overview, grouped
from workload.transactions import transactions

ALERTS = "alert_type string, tx_risk_score int"


def test_grid_is_complete(spark):
    alerts = spark.createDataFrame([("A", 2), ("A", 2), ("B", 5)], ALERTS)
    cells = {tuple(r)[:2]: tuple(r)[2:] for r in reports.alert_risk_grid(alerts).collect()}
    assert cells == {
        ("A", 2): (2, 2.0), ("A", 3): (0, 0.1), ("A", 4): (0, 0.1), ("A", 5): (0, 0.1),
        ("B", 2): (0, 0.1), ("B", 3): (0, 0.1), ("B", 4): (0, 0.1), ("B", 5): (1, 1.0),
    }


def test_grid_and_pivot_of_no_alerts(spark):
    none = spark.createDataFrame([], ALERTS)
    assert reports.alert_risk_grid(none).collect() == []
    assert reports.alert_risk_pivot(none).collect() == []


def test_pivot(spark):
    alerts = spark.createDataFrame([("A", 2), ("A", 2), ("B", 0)], ALERTS)
    rows = reports.alert_risk_pivot(alerts, highest=2).collect()
    assert [r.asDict() for r in rows] == [
        {"alert_type": "A", "0": 0, "1": 0, "2": 2},
        {"alert_type": "B", "0": 1, "1": 0, "2": 0},
    ]


def test_alerts_without_a_score(spark):
    alerts = spark.createDataFrame([("A", 1), ("B", None)], ALERTS)
    cells = {tuple(r)[:3] for r in reports.alert_risk_grid(alerts).collect()}
    assert cells == {("A", 1, 1), ("B", 1, 0)}
    rows = [tuple(r) for r in reports.alert_risk_pivot(alerts, highest=1).collect()]
    assert rows == [("A", 0, 1), ("B", 0, 0)]


def test_pivot_loses_no_score(spark):
    alerts = spark.createDataFrame([("A", 1), ("A", 30)], ALERTS)
    with pytest.raises(Exception, match="score outside 0 to 27: 30"):
        reports.alert_risk_pivot(alerts, highest=27).collect()
    assert reports.alert_risk_pivot(alerts, highest=30).first()["30"] == 1


def test_ties_are_ordered(spark):
    gold = spark.createDataFrame(
        [("T3", 1), ("T1", 1), ("T2", 9)], "transaction_id string, risk_score_simple int"
    )
    top = reports.top_risk_transactions(gold, 2, None).collect()
    assert [r["transaction_id"] for r in top] == ["T2", "T1"]


def test_unknown_day_is_a_group(spark):
    gold = spark.createDataFrame(
        [(None, 1.0), (None, 2.0), (dt.date(2026, 1, 1), 4.0)],
        "booking_date date, amount_usd double",
    )
    rows = [tuple(r) for r in reports.daily_trend(gold).collect()]
    assert rows == [(None, 2, 3.0), (dt.date(2026, 1, 1), 1, 4.0)]


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("reports") / "gold")
    stored = pipeline.gold(transactions(spark, "/root/testdata/sf0.001")).withColumns(
        {
            "dq_booking_ts_unparsed": F.lit(0),
            "dq_amount_invalid": (F.length("transaction_id") % 2).cast("int"),
            "channel": F.when(F.col("channel") != "ATM", F.col("channel")),
        }
    )
    stored.write.parquet(path)
    return spark.read.parquet(path)


def same(one, other):
    return one.columns == other.columns and sorted(map(str, one.collect())) == sorted(
        map(str, other.collect())
    )


def test_overview_has_every_report(gold):
    found = Overview.of(gold)
    alerts = to_alerts(gold)
    assert same(found.tx_type_mix(), reports.tx_type_mix(gold))
    assert same(found.channel_mix(), reports.channel_mix(gold))
    assert same(found.risk_distribution(), reports.risk_distribution(gold))
    assert same(found.daily_trend(), reports.daily_trend(gold))
    assert same(found.near_threshold_daily_rowsum(), reports.near_threshold_daily_rowsum(gold))
    assert same(found.flag_totals(), reports.flag_totals(gold))
    assert same(found.alert_type_counts(), reports.alert_type_counts(alerts))
    assert same(found.alert_risk_counts(), reports.alert_risk_counts(alerts))
    assert same(found.booking_status(), quality.booking_status(gold))
    assert same(found.amount_status(), quality.amount_status(gold))


def test_overview_scans_gold_once(gold):
    plan = grouped(gold)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "screening" not in plan.split("ReadSchema")[1]
    report = Overview.of(gold).channel_mix()._jdf.queryExecution().executedPlan().toString()
    assert report.count("FileScan") == 1 and "near_thr" not in report


def test_overview_of_nothing(gold):
    found = Overview.of(gold.limit(0))
    assert found.tx_type_mix().count() == 0 and found.alert_type_counts().count() == 0
    assert same(found.flag_totals(), reports.flag_totals(gold.limit(0)))


def test_histogram_counts_every_amount_once(spark):
    values = ["0.00", "0.01", "1.00", "9.99", "10.00", "-10.00", "1000000.00", "999999.99", None, "0.00"]
    table = spark.createDataFrame([(v,) for v in values], "v string").selectExpr(
        "cast(v AS decimal(18,2)) AS amount_usd"
    )
    found = {(r["sign"], r["bin"]): r for r in reports.amount_histogram(table, 1).collect()}
    assert {k: r["count"] for k, r in found.items()} == {
        (0, None): 2, (1, -2): 1, (1, 0): 2, (1, 1): 1, (-1, 1): 1, (1, 6): 1, (1, 5): 1,
    }
    assert (found[1, 1]["low"], found[1, 1]["high"]) == (10.0, 100.0)


def test_quantile_sketches_merge_within_their_bound(spark):
    # Amounts rise day by day, and one day has a third of them.
    n = 300_000
    table = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("booking_date"),
        ((F.col("id") * 7919) % n + 1).cast("decimal(18,2)").alias("amount_usd"),
    )
    sketches = reports.amount_sketches(table)
    assert sketches.count() == 40
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    fractions = [0.01, 0.1, 0.5, 0.9, 0.99]
    found = reports.amount_quantiles(sketches, fractions).collect()
    assert [r["fraction"] for r in found] == fractions
    for r in found:
        assert r["n"] == n
        # The amounts are a permutation of 1 to n, so an amount is its own rank.
        assert abs(r["amount_usd"] / n - r["fraction"]) < 0.01
    some = reports.amount_quantiles(sketches.where("booking_date = 0"), [0.5]).first()
    exact = table.where("booking_date = 0").agg(F.percentile("amount_usd", 0.5)).first()[0]
    assert abs(some["amount_usd"] - exact) < 0.01 * n
    assert reports.amount_quantiles(sketches.limit(0)).count() == 0
