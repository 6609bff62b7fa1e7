"""The layers as pure functions, and the run that writes each of them once."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from txmon.config import DEFAULT_RULES_CONFIG, RuleConfig
from txmon.operators import clean, features, quality
from txmon.operators.alerts import to_alerts
from txmon.operators.fx import convert_to_usd
from txmon.operators.rules import FLAGS, apply_rules, with_risk_score
from txmon.session import (
    configure,
    delete_folder,
    scratch_dir,
    short_shuffles,
    sized_for,
    stored_bytes,
)
from txmon.sources.files import with_lineage
from txmon.sources.layers import current_version, ensure_layers, write_layer
from txmon.sources.split_csv import read_split_csv

# --- fixed values: table names ---
BRONZE_TABLE = "transactions_bronze"
SILVER_TABLE = "transactions_silver"
GOLD_TABLE = "transactions_gold"
ALERTS_TABLE = "tx_alerts_gold"

# Stored silver whose gold is made at once, and in how many parts a larger one is made at most.
_PART_BYTES = 128 << 20
_MOST_PARTS = 16


def bronze(raw: DataFrame) -> DataFrame:
    return with_lineage(raw)


def silver(bronze_df: DataFrame, rates: DataFrame) -> DataFrame:
    cleaned = (
        bronze_df.transform(clean.null_tokens)
        .transform(clean.scrub_text)
        .transform(clean.normalize_codes)
        .transform(clean.parse_booleans)
        .transform(clean.clean_amount)
        .transform(clean.parse_timestamps)
    )
    return convert_to_usd(cleaned, rates)


def gold(
    silver_df: DataFrame, cfg: RuleConfig = DEFAULT_RULES_CONFIG, known: DataFrame | None = None
) -> DataFrame:
    """Features, flags and score; the join keys come first.

    ``silver_df`` should be a stored table: it is scanned three times, twice for a few
    columns only. If it is a part, ``known`` are the account features of all.
    """
    helpers = features.with_gold_helpers(silver_df, cfg)
    scored = with_risk_score(
        apply_rules(features.with_account_features(helpers, cfg, known), cfg=cfg)
    )
    first = ["account_id", "booking_date"]
    last = [*features.ACCOUNT_FEATURES, *FLAGS, "risk_score_simple"]
    middle = [c for c in helpers.columns if c not in first]
    return scored.select(*first, *middle, *last)


@contextlib.contextmanager
def gold_parts(
    silver_df: DataFrame, version: str, cfg: RuleConfig = DEFAULT_RULES_CONFIG
) -> Iterator[list[DataFrame]]:
    """Gold of a silver table stored in a folder, in parts if it is large.

    Transactions are shuffled whole, twice, so their shuffles need several times the disk of the
    table. A part has a share of the files, and its shuffles are gone before the next begins.
    The features are those of all transactions; they are stored once, and a part reads those of
    its files' times.
    """
    spark = silver_df.sparkSession
    parts = min(_MOST_PARTS, math.ceil(stored_bytes(spark, version) / _PART_BYTES))
    second = F.col("booking_ts_ts").cast("bigint")
    files = (
        silver_df.sparkSession.read.schema(silver_df.schema)
        .parquet(version)
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(
            F.max("_metadata.file_size").alias("size"),
            F.min(second).alias("least"),
            F.max(second).alias("most"),
        )
        .collect()  # a row for each file
        if parts > 1
        else []
    )
    if len(files) < 2:
        yield [gold(silver_df, cfg)]
        return
    path = scratch_dir(spark, "account-features")
    with short_shuffles(spark):
        figures = features.account_features(features.with_gold_helpers(silver_df, cfg), cfg)
        figures.write.option("compression", "zstd").parquet(path)
    try:
        stored = spark.read.schema(figures.schema).parquet(path)
        yield [_gold_part(silver_df, version, own, stored, cfg) for own in _shares(files, parts)]
    finally:
        delete_folder(spark, path)


def _shares(files: Sequence[Row], parts: int) -> list[list[Row]]:
    """Files in some parts of nearly equal size, those of similar times together."""
    share, so_far = sum(f.size for f in files) / parts, 0
    found: dict[int, list[Row]] = {}
    for f in sorted(files, key=lambda f: (f.least is not None, f.least or 0, f.name)):
        found.setdefault(int((so_far + f.size / 2) / share), []).append(f)
        so_far += f.size
    return list(found.values())


def _gold_part(
    silver_df: DataFrame, version: str, files: Sequence[Row], known: DataFrame, cfg: RuleConfig
) -> DataFrame:
    paths = [f"{version}/{f.name}" for f in files]
    own = silver_df.sparkSession.read.schema(silver_df.schema).parquet(*paths)
    times = [t for f in files for t in (f.least, f.most) if t is not None]
    needed = F.col("ts_sec").isNull()
    if times:
        needed |= F.col("ts_sec").between(min(times), max(times))
    return gold(own, cfg, known.filter(needed))


def alerts(gold_df: DataFrame) -> DataFrame:
    return to_alerts(gold_df)


@dataclass(frozen=True)
class Layers:
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    alerts: DataFrame
    # What was counted while each layer was written: rows, NULLs of the core columns in bronze,
    # how often each rule fired in gold.
    observed: Mapping[str, Mapping[str, int]]


def run(
    spark: SparkSession,
    raw_path: str | list[str],
    rates: DataFrame,
    prefix: str = "",
    location: str | None = None,
    cfg: RuleConfig = DEFAULT_RULES_CONFIG,
    keep_raw: bool = True,
) -> Layers:
    """Raw files to alerts. Each layer is written once and the next reads it from storage.

    Shuffles are sized by the silver table as stored. Gold lies in a folder for each booking
    date, sorted by account, so a day or an account of a day is read without the rest. Without
    ``keep_raw`` the raw files, which are folders then, go as soon as bronze has their records.
    """
    configure(spark)
    ensure_layers(spark, prefix, location)
    observed: dict[str, Mapping[str, int]] = {}

    def write(
        df: DataFrame | list[DataFrame], layer: str, table: str, figures: list[Column], **layout
    ) -> DataFrame:
        seen: list[Observation] = []

        def observe(part: DataFrame) -> DataFrame:
            seen.append(Observation(f"{prefix}{table}"))
            return part.observe(seen[-1], *figures)

        written = write_layer(df, layer, table, prefix, observe=observe, **layout)
        counts = [part.get for part in seen]
        total = {name: sum(c[name] for c in counts) for name in counts[0]}
        observed["alerts" if table == ALERTS_TABLE else layer] = total
        return written

    rows = F.count(F.lit(1)).alias("rows")
    fired = [F.count_if(F.col(flag)).alias(flag) for flag in FLAGS]
    raw = read_split_csv(spark, raw_path)
    b = write(bronze(raw), "bronze", BRONZE_TABLE, quality.null_figures())
    if not keep_raw:
        for path in [raw_path] if isinstance(raw_path, str) else raw_path:
            delete_folder(spark, path)
    s = write(silver(b, rates), "silver", SILVER_TABLE, [rows])
    version = current_version(spark, "silver", SILVER_TABLE, prefix)
    with sized_for(spark, stored_bytes(spark, version)), gold_parts(s, version, cfg) as parts:
        g = write(
            parts,
            "gold",
            GOLD_TABLE,
            [rows, *fired],
            partition_by=["booking_date"],
            cluster_by=["account_id"],
        )
    a = write(alerts(g), "gold", ALERTS_TABLE, [rows])
    return Layers(b, s, g, a, observed)
