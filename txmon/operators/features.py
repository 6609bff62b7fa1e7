"""Gold features: helper predicates, account-day aggregates and time-range sums.

One account may hold a large share of all rows, so no step gathers an account's raw rows
in one task:

* transactions are first summed per (account, second), which Spark does before shuffling;
* the time ranges run over those sums in blocks of one week per account, so a window
  partition has at most as many rows as a week (plus the look-around) has seconds;
* inside a block a range sum is the difference of two running sums, linear in the block;
* ranges longer than a block would copy every second to many blocks. There each amount enters a
  running sum and leaves it again, once each, and block totals, summed up first, carry the sum
  from block to block (see ``_prefix_features``);
* the transactions meet their features in one join on (account, second), whose hot
  partitions AQE splits. The near-threshold figures ride along on the same join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmon.config import DEFAULT_RULES_CONFIG, MONEY, MONEY_SUM, RuleConfig
from txmon.functions import signals
from txmon.operators.joins import attach

_BLOCK_SECONDS = 7 * 86_400
_NEAR_FEATURES = {
    "near_thr_cash_cnt": "bigint",
    "near_thr_cash_sum_usd": MONEY_SUM,
    "near_thr_cash_dist_depositors": "bigint",
}
ACCOUNT_FEATURES = (*_NEAR_FEATURES, "ts_sec", "prev24h_credit_sum_usd", "rapid_seq_txn_cnt")


def with_gold_helpers(df: DataFrame, cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> DataFrame:
    return df.withColumns(
        {
            "booking_date": F.to_date("booking_ts_ts"),
            "amount_usd": F.col("amount_usd").cast(MONEY),
            "is_cash_credit": signals.cash_credit(),
            "is_wire_debit": signals.wire_debit(cfg),
            "is_cross_border": signals.cross_border(),
            "screening_text": signals.folded("screening_events_json"),
            "geo_text": signals.folded("geo_events_json"),
        }
    )


def near_threshold_daily(df: DataFrame, cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> DataFrame:
    """Per account and day: count, sum and distinct originators of near-threshold cash."""
    return (
        df.where(signals.near_threshold(cfg))
        .groupBy("account_id", F.to_date("booking_ts_ts").alias("booking_date"))
        .agg(
            F.count("*").alias("near_thr_cash_cnt"),
            F.sum("amount_usd").alias("near_thr_cash_sum_usd"),
            F.countDistinct("originator_party_id").alias("near_thr_cash_dist_depositors"),
        )
    )


def with_near_threshold(df: DataFrame, cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> DataFrame:
    """Add the account-day figures to every transaction of that day, zeros where none."""
    df = df.withColumn("booking_date", F.to_date("booking_ts_ts"))
    daily = near_threshold_daily(df, cfg)
    return attach(df, daily, ["account_id", "booking_date"]).withColumns(_near_or_zero())


def with_prev_credit(df: DataFrame, seconds: int = 24 * 3600) -> DataFrame:
    """Add the account's credits in the ``seconds`` before the transaction's own second."""
    ranges = _ranges(_per_second(df), seconds, 0)
    return _by_second(df, ranges.drop("rapid_seq_txn_cnt"))


def with_rapid_sequence(df: DataFrame, seconds: int = 10 * 60) -> DataFrame:
    """Add the account's number of transactions within ``seconds`` before or after."""
    ranges = _ranges(_per_second(df), 0, seconds)
    return _by_second(df, ranges.drop("prev24h_credit_sum_usd"))


def with_account_features(
    df: DataFrame, cfg: RuleConfig = DEFAULT_RULES_CONFIG, known: DataFrame | None = None
) -> DataFrame:
    """Near-threshold, prior-credit and burst features in one join on the transactions.

    ``known`` are the :func:`account_features` of all transactions, if ``df`` has not all.
    """
    return _by_second(df, account_features(df, cfg) if known is None else known)


def account_features(df: DataFrame, cfg: RuleConfig = DEFAULT_RULES_CONFIG) -> DataFrame:
    """The features of each account and second that has transactions."""
    ranges = _ranges(_per_second(df), cfg.credit_lookback_seconds, cfg.burst_radius_seconds)
    day = F.to_date(F.timestamp_seconds("ts_sec"))
    return (
        ranges.withColumn("booking_date", day)
        .join(near_threshold_daily(df, cfg), ["account_id", "booking_date"], "left")
        .withColumns(_near_or_zero())
        .drop("booking_date")
    )


def _near_or_zero() -> dict[str, Column]:
    return {c: F.coalesce(c, F.lit(0).cast(t)) for c, t in _NEAR_FEATURES.items()}


def _event_second() -> Column:
    return F.col("booking_ts_ts").cast("timestamp").cast("bigint")


def _per_second(df: DataFrame) -> DataFrame:
    """Credits and transactions per account and second; the unknown second is one, too."""
    credit = F.when(F.col("direction") == "CREDIT", F.col("amount_usd"))
    return df.groupBy("account_id", _event_second().alias("ts_sec")).agg(
        F.coalesce(F.sum(credit), F.lit(0)).cast(MONEY_SUM).alias("credit"),
        F.count("*").alias("txns"),
    )


def _ranges(per_second: DataFrame, lookback: int, radius: int) -> DataFrame:
    """Credits over [t - lookback, t - 1] and transactions over [t - radius, t + radius]."""
    # Up to a block's length, at most the seconds near a block's edge are copied.
    short = max(lookback, radius) <= _BLOCK_SECONDS
    features = _range_features if short else _prefix_features
    return features(per_second, lookback, radius)


def _range_features(per_second: DataFrame, lookback: int, radius: int) -> DataFrame:
    """The ranges by frames inside blocks.

    A second is copied to every block with a time that sees it: its own, and with weekly
    blocks only near the edges a neighbour. Transactions without a time see each other and
    nothing else, which is exactly their own sum.
    """
    reach = max(lookback, radius)
    block = lambda second: F.floor(second / F.lit(_BLOCK_SECONDS)).cast("bigint")
    second = F.col("ts_sec")
    placed = per_second.withColumn(
        "__block", F.explode_outer(F.sequence(block(second - radius), block(second + reach)))
    )
    window = Window.partitionBy("account_id", "__block").orderBy("ts_sec")

    def running(column: str, up_to: int) -> Column:
        total = F.sum(column).over(window.rangeBetween(Window.unboundedPreceding, up_to))
        return F.coalesce(total, F.lit(0))

    unknown = second.isNull()
    credits = running("credit", -1) - running("credit", -lookback - 1)
    nearby = running("txns", radius) - running("txns", -radius - 1)
    return (
        placed.withColumns({"__credits": credits, "__nearby": nearby})
        .where(F.col("__block").eqNullSafe(block(second)))
        .select(
            "account_id",
            "ts_sec",
            F.when(unknown, F.col("credit"))
            .otherwise(F.col("__credits"))
            .cast(MONEY_SUM)
            .alias("prev24h_credit_sum_usd"),
            F.when(unknown, F.col("txns")).otherwise(F.col("__nearby")).alias("rapid_seq_txn_cnt"),
        )
    )


def _moves(per_second: DataFrame, lookback: int, radius: int) -> DataFrame:
    """When a second's figures begin and cease to count, one row each, in the block of that time.

    ``gone`` is a credit that the lookback of this second no longer reaches; ``near`` adds the
    transactions that the radius begins to reach and takes off those it leaves behind. So
    there are at most four rows a second, however long the ranges are.
    """
    second, none = F.col("ts_sec"), F.lit(0)

    def move(at: Column, **figures: Column) -> Column:
        values = {"credit": none, "gone": none, "near": none, "txns": none} | figures
        kinds = {"credit": MONEY_SUM, "gone": MONEY_SUM, "near": "bigint", "txns": "bigint"}
        fields = [values[name].cast(kind).alias(name) for name, kind in kinds.items()]
        return F.struct(at.alias("at"), *fields)

    known = F.array(
        move(second, credit=F.col("credit"), txns=F.col("txns")),
        move(second + lookback + 1, gone=F.col("credit")),
        move(second - radius, near=F.col("txns")),
        move(second + radius + 1, near=-F.col("txns")),
    )
    unknown = F.array(move(second, credit=F.col("credit"), txns=F.col("txns")))
    some = lambda m: (m["txns"] != 0) | (m["gone"] != 0) | (m["near"] != 0)
    placed = F.when(second.isNull(), unknown).otherwise(F.filter(known, some))
    return per_second.select("account_id", F.inline(placed)).withColumn(
        "__block", F.floor(F.col("at") / _BLOCK_SECONDS).cast("bigint")
    )


def _prefix_features(per_second: DataFrame, lookback: int, radius: int) -> DataFrame:
    """The ranges by prefix sums on two levels: over an account's blocks and inside a block.

    What counts at a second is what began to count up to it less what ceased to. The sums up
    to a block's start come from block totals, of which an account has one a week; a window
    partition has at most four rows for each second of a block.
    """
    moves = _moves(per_second, lookback, radius)
    figures = ("credit", "gone", "near")
    known = moves.where("__block IS NOT NULL")
    totals = known.groupBy("account_id", "__block").agg(*(F.sum(c).alias(c) for c in figures))
    earlier = (
        Window.partitionBy("account_id")
        .orderBy("__block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = totals.select(
        "account_id",
        "__block",
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}") for c in figures),
    )
    inside = Window.partitionBy("account_id", "__block").orderBy("at")

    def upto(column: str, end: int) -> Column:
        total = F.sum(column).over(inside.rangeBetween(Window.unboundedPreceding, end))
        return F.coalesce(total, F.lit(0)) + F.col(f"__{column}")

    second = F.col("at")
    prior = upto("credit", -1) - upto("gone", 0)
    # Only rows with transactions are seconds to report; the others are moves.
    return (
        attach(moves, starts, ["account_id", "__block"], match_unknown=True)
        .withColumns({"__prior": prior, "__nearby": upto("near", 0)})
        .where("txns > 0")
        .select(
            "account_id",
            second.alias("ts_sec"),
            F.when(second.isNull(), F.col("credit"))
            .otherwise(F.col("__prior"))
            .cast(MONEY_SUM)
            .alias("prev24h_credit_sum_usd"),
            F.when(second.isNull(), F.col("txns"))
            .otherwise(F.col("__nearby"))
            .cast("bigint")
            .alias("rapid_seq_txn_cnt"),
        )
    )


def _by_second(df: DataFrame, features: DataFrame) -> DataFrame:
    """Join per-second features to the transactions; unknown accounts and times match, too."""
    df = df.withColumn("ts_sec", _event_second())
    return attach(df, features, ["account_id", "ts_sec"], match_unknown=True)
