"""All grouped reports of a run from one scan of gold.

One aggregation with grouping sets counts gold by every report's key at once; the result has as
many rows as all reports together, is stored, and each report is read from it. Reports that
need rows or another key (top lists, the drill-down) stay in ``reports``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.operators.rules import FLAGS, RULES
from txmon.session import scratch_dir

_KEYS = (
    "transaction_type", "channel", "risk_score_simple", "booking_date",
    "dq_booking_ts_unparsed", "dq_amount_invalid",
)
_SUMS = {
    "total_usd": "amount_usd",
    "near_thr_cash_cnt_total": "near_thr_cash_cnt",
    "near_thr_cash_sum_usd_total": "near_thr_cash_sum_usd",
}


def grouped(gold: DataFrame) -> DataFrame:
    """``report``, the keys, ``count``, sums and how often each rule fired; ``report`` is the
    name of the key a row is grouped by, NULL for the row of all. Columns that gold lacks
    have no report.
    """
    keys = [c for c in _KEYS if c in gold.columns]
    sets = [*([F.col(c)] for c in keys), []]
    names = [F.when(F.grouping(c) == 0, F.lit(c)) for c in keys]
    return gold.groupingSets(sets, *keys).agg(
        F.coalesce(*names).alias("report"),
        F.count(F.lit(1)).alias("count"),
        *(F.sum(column).alias(name) for name, column in _SUMS.items()),
        *(F.count_if(F.col(flag)).alias(flag) for flag in FLAGS),
    )


@dataclass(frozen=True)
class Overview:
    """The reports, each as the function of the same name in ``reports`` or ``quality`` has it."""

    table: DataFrame

    @classmethod
    def of(cls, gold: DataFrame) -> Overview:
        spark = gold.sparkSession
        path = scratch_dir(spark, "overview")
        grouped(gold).write.parquet(path)
        return cls(spark.read.parquet(path))

    def _by(self, key: str) -> DataFrame:
        return self.table.where(F.col("report") == key)

    def _mix(self, key: str) -> DataFrame:
        return self._by(key).select(key, "count").orderBy(F.desc("count"), key)

    def tx_type_mix(self) -> DataFrame:
        return self._mix("transaction_type")

    def channel_mix(self) -> DataFrame:
        return self._mix("channel")

    def risk_distribution(self) -> DataFrame:
        key = "risk_score_simple"
        return self._by(key).select(key, "count").orderBy(key)

    def daily_trend(self) -> DataFrame:
        day = self._by("booking_date").orderBy("booking_date")
        return day.select("booking_date", F.col("count").alias("tx_count"), "total_usd")

    def near_threshold_daily_rowsum(self) -> DataFrame:
        day = self._by("booking_date").orderBy("booking_date")
        return day.select(
            "booking_date", "near_thr_cash_cnt_total", "near_thr_cash_sum_usd_total"
        )

    def flag_totals(self) -> DataFrame:
        # There is one such row, or none, which gives NULLs as sums of nothing do.
        return self.table.where("report IS NULL").agg(*(F.max(f).alias(f) for f in FLAGS))

    def alert_type_counts(self) -> DataFrame:
        """An alert for each time a rule fired, so the rules' totals are the alerts' counts."""
        return self._alerts(self.table.where("report IS NULL")).orderBy(
            F.desc("count"), "alert_type"
        )

    def alert_risk_counts(self) -> DataFrame:
        rows = self._by("risk_score_simple")
        return self._alerts(rows, F.col("risk_score_simple").cast("int").alias("tx_risk_score"))

    def booking_status(self) -> DataFrame:
        return self._marked("dq_booking_ts_unparsed", "Unparsed booking_ts", "Parsed booking_ts")

    def amount_status(self) -> DataFrame:
        return self._marked("dq_amount_invalid", "Invalid amount", "Valid amount")

    def _marked(self, key: str, when_set: str, otherwise: str) -> DataFrame:
        status = F.when(F.col(key) == 1, F.lit(when_set)).otherwise(F.lit(otherwise))
        return self._by(key).select(status.alias("status"), "count")

    def _alerts(self, rows: DataFrame, *more) -> DataFrame:
        fired = F.inline(
            F.array(
                *(
                    F.struct(F.lit(r.code).alias("alert_type"), F.col(r.flag).alias("fired"))
                    for r in RULES
                )
            )
        )
        return (
            rows.select(*more, fired)
            .where("fired > 0")
            .withColumnRenamed("fired", "count")
            .select("alert_type", *(["tx_risk_score"] if more else []), "count")
        )

    def long(self) -> DataFrame:
        """``report, key, count`` of every row, keys as text; alerts by type are among them."""
        keys = [c for c in _KEYS if c in self.table.columns]
        parts = [
            self._by(c).select(F.lit(c).alias("report"), F.col(c).cast("string").alias("key"), "count")
            for c in keys
        ]
        alerts = self.alert_type_counts().select(
            F.lit("alert_type").alias("report"), F.col("alert_type").alias("key"), "count"
        )
        return reduce(DataFrame.unionByName, [*parts, alerts])
