"""What a run of the layers needs on the disks beside its tables."""

from __future__ import annotations

import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from txmon.operators import quality
from txmon.plans import pipeline, reports
from txmon.sources import files, layers
from workload import queries as registry
from workload.queries import _rates, _raw_file
from workload.transactions import raw_transactions, transactions

SF = "/root/testdata/sf0.001"


def _folder(version):
    return Path(version.removeprefix("file:"))


@pytest.fixture
def silver(spark, tmp_path):
    """Silver in several files, some transactions without a time, one file with none else."""
    layers.ensure_layers(spark, "d_", str(tmp_path))
    event = F.col("event_id")
    tx = transactions(spark, SF).withColumn(
        "booking_ts_ts",
        F.when((event % 50 != 7) & (event < 900), F.col("booking_ts_ts")),
    )
    parts = [tx.where(event.between(lo, lo + 99)).coalesce(1) for lo in range(0, 1000, 100)]
    written = layers.write_layer(parts, "silver", "t", "d_")
    return written, layers.current_version(spark, "silver", "t", "d_")


def test_gold_in_parts_is_gold(silver, monkeypatch):
    table, version = silver
    assert len(list(_folder(version).glob("*.parquet"))) == 10
    whole = pipeline.gold(table)
    with pipeline.gold_parts(table, version) as one:
        assert len(one) == 1
    monkeypatch.setattr(pipeline, "_PART_BYTES", 1)
    monkeypatch.setattr(pipeline, "_MOST_PARTS", 4)
    with pipeline.gold_parts(table, version) as parts:
        assert len(parts) == 4
        counts = [p.count() for p in parts]
        assert sum(counts) == 1000 and max(counts) < 500
        together = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
        assert together.schema == whole.schema
        assert sorted(map(str, together.collect())) == sorted(map(str, whole.collect()))


def test_a_run_in_parts_counts_all(spark, tmp_path, settings, monkeypatch):
    raw, other = str(tmp_path / "raw"), str(tmp_path / "other")
    for path in (raw, other):
        files.write_raw_csv(raw_transactions(spark, SF, spread=True), path, records_per_file=100)
    whole = pipeline.run(spark, raw, _rates(spark, SF), "da_", str(tmp_path / "a"))
    assert Path(raw).exists()
    settings({"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"})
    monkeypatch.setattr(pipeline, "_PART_BYTES", 10_000)
    features = []
    make = pipeline.features.account_features
    monkeypatch.setattr(
        pipeline.features, "account_features", lambda *a: features.append(1) or make(*a)
    )
    run = pipeline.run(
        spark, other, _rates(spark, SF), "db_", str(tmp_path / "b"), keep_raw=False
    )
    assert not Path(other).exists() and len(features) == 1
    lineage = ["_ingest_ts", "_source_file"]
    for name in ("bronze", "silver", "gold", "alerts"):
        a, b = (getattr(x, name).drop(*lineage) for x in (whole, run))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {k: dict(v) for k, v in run.observed.items()} == {
        k: dict(v) for k, v in whole.observed.items()
    }
    rows = {r["layer"]: r["rows"] for r in quality.observed_counts(spark, run.observed).collect()}
    assert rows["gold"] == 1000
    fired = reports.flag_totals(run.gold).first().asDict()
    assert {f: run.observed["gold"][f] for f in fired} == fired


def test_layers_are_compressed_and_leave_no_shuffle(spark, tmp_path):
    layers.ensure_layers(spark, "dc_", str(tmp_path))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = blocks.getAllFiles()
        return sum("shuffle_" in found.apply(i).getName() for i in range(found.size()))

    before = shuffles()
    rows = spark.range(5000).repartition(7, "id").withColumn("part", F.col("id") % 3)
    layers.write_layer(rows, "gold", "t", "dc_", partition_by=["part"])
    for _ in range(50):  # they go a moment later
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    written = list(_folder(layers.current_version(spark, "gold", "t", "dc_")).glob("*/*.parquet"))
    assert len(written) >= 3
    for file in written:
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_raw_files_hold_ranges_of_what_arrived(spark):
    found = spark.read.csv(_raw_file(spark, SF), header=True, quote='"', escape='"', multiLine=True)
    number = F.substring("transaction_id", 2, 20).cast("long")
    ranges = (
        found.groupBy(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).alias("f"))
        .agg(F.min(number).alias("lo"), F.max(number).alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert len(ranges) > 1
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("query", ["layer_listing", "layer_counts", "pipeline_alerts"])
def test_runs_leave_their_tables_only(spark, query, monkeypatch):
    made = []
    raw = registry._raw_file
    monkeypatch.setattr(registry, "_raw_file", lambda *a: made.append(raw(*a)) or made[-1])
    assert registry.queries()[query](spark, SF).count() > 0
    assert made and not any(_folder(p).exists() for p in made)
