from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txmon.operators import features

SCHEMA = (
    "id int, account_id string, booking_ts_ts timestamp, amount_usd decimal(18,2), "
    "direction string, transaction_type string, originator_party_id string"
)
EPOCH = dt.datetime(1970, 1, 1)


def table(spark, rows):
    """``(account, second, amount, direction[, originator])`` rows."""
    data = [
        (
            i,
            account,
            None if second is None else EPOCH + dt.timedelta(seconds=second),
            None if amount is None else Decimal(amount),
            direction,
            "CASH",
            party[0] if party else "P",
        )
        for i, (account, second, amount, direction, *party) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


# account, second, amount, direction, credits of the last day, transactions within 10 minutes
KNOWN = [
    ("A", None, "10", "CREDIT", "30", 2),
    ("A", None, "20", "CREDIT", "30", 2),
    ("A", 1000, "30", "CREDIT", "0", 3),
    ("A", 1000, "40", "CREDIT", "0", 3),
    ("A", 1001, "5", "DEBIT", "70", 3),
    ("A", 87400, "1", "DEBIT", "70", 2),
    ("A", 87401, "1", "DEBIT", "0", 2),
    (None, 1000, "7", "CREDIT", "0", 2),
    (None, 1001, "7", "CREDIT", "7", 2),
]


def test_known_windows(spark):
    df = table(spark, [row[:4] for row in KNOWN])
    want = [(Decimal(credit), near) for *_, credit, near in KNOWN]
    prev = features.with_prev_credit(df).orderBy("id").collect()
    rapid = features.with_rapid_sequence(df).orderBy("id").collect()
    got = [
        (p["prev24h_credit_sum_usd"], r["rapid_seq_txn_cnt"])
        for p, r in zip(prev, rapid, strict=True)
    ]
    assert got == want


def brute_force(rows, lookback, radius):
    results = []
    for account, second, *_ in rows:
        peers = [r for r in rows if r[0] == account]
        if second is None:
            before = [r for r in peers if r[1] is None]
            near = before
        else:
            known = [r for r in peers if r[1] is not None]
            before = [r for r in known if second - lookback <= r[1] <= second - 1]
            near = [r for r in known if abs(r[1] - second) <= radius]
        credit = sum(
            (Decimal(r[2]) for r in before if r[3] == "CREDIT" and r[2] is not None), Decimal(0)
        )
        results.append((credit, len(near)))
    return results


def random_rows(seed, size):
    rng = random.Random(seed)
    week = 7 * 86400
    # Times cluster around block edges, on both sides of 1970, and repeat.
    centers = [0, week, 2 * week, -week, 3 * week - 86400, 5 * week + 300]
    rows = []
    for _ in range(size):
        # One account holds half of the rows.
        account = rng.choice(["hot", "hot", "hot", "B", "C", None])
        second = rng.choice(centers) + rng.choice([-1, 1]) * int(rng.expovariate(1 / 30000))
        rows.append(
            (
                account,
                rng.choice([second, second, second, second, None]),
                rng.choice([None, str(rng.randrange(-500, 100000) / 100)]),
                rng.choice(["CREDIT", "DEBIT", None]),
            )
        )
    return rows


@pytest.mark.parametrize(("lookback", "radius"), [(86400, 600), (1, 1), (3600, 200_000)])
def test_windows_against_brute_force(spark, lookback, radius):
    rows = random_rows(lookback, 400)
    df = table(spark, rows).repartition(5)
    want = brute_force(rows, lookback, radius)
    prev = features.with_prev_credit(df, lookback).orderBy("id").collect()
    rapid = features.with_rapid_sequence(df, radius).orderBy("id").collect()
    assert [r["prev24h_credit_sum_usd"] for r in prev] == [credit for credit, _ in want]
    assert [r["rapid_seq_txn_cnt"] for r in rapid] == [near for _, near in want]


@pytest.mark.parametrize(
    ("lookback", "radius"), [(90 * 86400, 600), (86400, 30 * 86400), (400 * 86400, 0), (1, 8 * 86400)]
)
def test_long_ranges_against_brute_force(spark, lookback, radius):
    rows = random_rows(lookback, 300)
    rows += [(a, s + 40 * 86400 if s is not None else None, *more) for a, s, *more in rows]
    df = table(spark, rows).repartition(5)
    want = brute_force(rows, lookback, radius)
    ranges = features._ranges(features._per_second(df), lookback, radius)
    got = features._by_second(df, ranges).orderBy("id").collect()
    assert [r["prev24h_credit_sum_usd"] for r in got] == [credit for credit, _ in want]
    assert [r["rapid_seq_txn_cnt"] for r in got] == [near for _, near in want]


@pytest.mark.parametrize(("lookback", "radius"), [(86400, 600), (7 * 86400, 86400), (1, 0)])
def test_both_ways_agree(spark, lookback, radius):
    sums = features._per_second(table(spark, random_rows(11, 400)))
    found = [
        sorted(map(str, way(sums, lookback, radius).collect()))
        for way in (features._range_features, features._prefix_features)
    ]
    assert found[0] == found[1]


def test_placed_rows_do_not_grow_with_the_range(spark):
    sums = features._per_second(table(spark, random_rows(12, 400)))
    seconds = sums.count()
    placed = {
        features._moves(sums, days * 86400, 600).count() for days in (30, 90, 3650)
    }
    assert len(placed) == 1 and placed.pop() <= 4 * seconds


def test_windows_against_direct_range_frames(spark):
    """The same figures as Spark's own sliding frames over the raw rows."""
    df = table(spark, random_rows(99, 600)).withColumn("t", F.col("booking_ts_ts").cast("bigint"))
    credit = "CASE WHEN direction = 'CREDIT' THEN amount_usd ELSE 0 END"
    frame = "OVER (PARTITION BY account_id ORDER BY t RANGE BETWEEN"
    direct = df.selectExpr(
        "id",
        f"coalesce(sum({credit}) {frame} 86400 PRECEDING AND 1 PRECEDING), 0) AS credit",
        f"count(*) {frame} 600 PRECEDING AND 600 FOLLOWING) AS near",
    )
    ours = features.with_account_features(df).select(
        "id",
        F.col("prev24h_credit_sum_usd").alias("credit"),
        F.col("rapid_seq_txn_cnt").alias("near"),
    )
    assert [tuple(r) for r in ours.orderBy("id").collect()] == [
        tuple(r) for r in direct.orderBy("id").collect()
    ]


def test_near_threshold_days(spark):
    day = 86400
    df = table(
        spark,
        [
            ("A", 10, "8000", "CREDIT", "P1"),
            ("A", 20, "9999.99", "CREDIT", "P1"),
            ("A", 30, "9000", "CREDIT", None),
            ("A", 40, "10000", "CREDIT", "P2"),
            ("A", 50, "7999.99", "CREDIT", "P2"),
            ("A", 60, "9000", "DEBIT", "P2"),
            ("A", day, "9000", "CREDIT", "P2"),
            (None, 10, "9000", "CREDIT", "P1"),
            ("A", None, "9000", "CREDIT", "P1"),
            ("A", 70, None, "CREDIT", "P1"),
        ],
    )
    daily = {
        (r["account_id"], r["booking_date"].day): tuple(r)[2:]
        for r in features.near_threshold_daily(df).collect()
    }
    assert daily == {
        ("A", 1): (3, Decimal("26999.99"), 1),
        ("A", 2): (1, Decimal("9000.00"), 1),
        (None, 1): (1, Decimal("9000.00"), 1),
    }
    rows = features.with_near_threshold(df).orderBy("id").collect()
    counts = [r["near_thr_cash_cnt"] for r in rows]
    # An unknown account or day matches nothing.
    assert counts == [3, 3, 3, 3, 3, 3, 1, 0, 0, 3]
    joined = features.with_account_features(df).orderBy("id").collect()
    assert [r["near_thr_cash_cnt"] for r in joined] == counts


def test_another_account_changes_nothing(spark):
    rows = random_rows(5, 200)
    before = features.with_account_features(table(spark, rows))
    more = rows + [("new", 100, "9000", "CREDIT")] * 3
    after = features.with_account_features(table(spark, more)).where(f"id < {len(rows)}")
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


def test_row_order_and_partitions_do_not_matter(spark):
    df = table(spark, random_rows(6, 200))
    spread = df.repartition(7, F.rand(3))
    assert sorted(map(str, features.with_account_features(df).collect())) == sorted(
        map(str, features.with_account_features(spread).collect())
    )
