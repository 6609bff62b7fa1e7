from __future__ import annotations

import datetime as dt
import re
from pathlib import Path
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from txmon.config import TIMESTAMP_COLUMNS
from txmon.operators import fx, quality
from txmon.plans import pipeline, reports
from txmon.session import scratch_dir, shuffle_sizes, sized_for
from txmon.sources import files, layers, rates
from workload.queries import _rates, _raw_file
from workload.transactions import raw_transactions

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("other", ["b,a\n3,4\n", "a,b,c\n3,4,5\n", "a\n3\n"])
@pytest.mark.parametrize("columns", [None, ["a", "b"]])
def test_csv_headers_must_agree(spark, tmp_path, other, columns):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text(other)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw_csv(spark, str(tmp_path), columns).collect()


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,last\n1,"say ""hi"",\nyou",\n2, padded ,""\n3,short\n')
    rows = files.read_raw_csv(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [
        ("1", 'say "hi",\nyou', None), ("2", " padded ", None), ("3", "short", None),
    ]
    named = files.read_raw_csv(spark, str(tmp_path), ["id", "text", "last"])
    assert sorted(named.collect()) == sorted(rows)


def test_lineage(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    row = files.with_lineage(files.read_raw_csv(spark, str(tmp_path))).first()
    assert row["_source_file"].endswith("a.csv") and row["_ingest_ts"] is not None


def test_layers_replace_and_list(spark, tmp_path):
    layers.ensure_layers(spark, "t_", str(tmp_path))
    layers.ensure_layers(spark, "t_", str(tmp_path))
    assert layers.current_version(spark, "gold", "numbers", "t_") is None
    layers.write_layer(spark.range(3), "gold", "numbers", "t_")
    layers.write_layer(spark.range(5), "gold", "numbers", "t_")
    assert layers.read_layer(spark, "gold", "numbers", "t_").count() == 5
    spark.range(1).createOrReplaceTempView("passing")
    assert [r["tableName"] for r in layers.list_layer(spark, "gold", "t_").collect()] == ["numbers"]
    spark.catalog.dropTempView("passing")
    with pytest.raises(ValueError, match="platinum"):
        layers.read_layer(spark, "platinum", "numbers")


def test_layers_are_cheap_to_write(spark, tmp_path):
    layers.ensure_layers(spark, "w_", str(tmp_path))
    df = spark.range(100).select(F.col("id").cast("string"), F.timestamp_seconds("id").alias("at"))
    written = layers.write_layer(df, "gold", "times", "w_")
    assert written.exceptAll(df).isEmpty() and df.exceptAll(written).isEmpty()
    for file in Path(layers.current_version(spark, "gold", "times", "w_")).glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        kinds = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert kinds["at"].physical_type == "INT64"
        assert not any("DICTIONARY" in e for c in kinds.values() for e in c.encodings)


def test_raw_files_are_made_by_many_tasks(spark):
    # The events are one row group, which is one task's.
    files_made = Path(_raw_file(spark, SF)).glob("*.csv")
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in files_made}) > 1


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    layers.ensure_layers(spark, "f_", str(tmp_path))
    layers.write_layer(spark.range(100), "gold", "t", "f_")
    before = layers.current_version(spark, "gold", "t", "f_")
    # Most tasks write their rows, one fails.
    rows = spark.range(0, 1000, 1, 8).withColumn(
        "id", F.when(F.col("id") == 999, F.raise_error(F.lit("half-way")).cast("long")).otherwise(F.col("id"))
    )
    for partition_by in ([], ["part"]):
        with pytest.raises(Exception, match="half-way"):
            layers.write_layer(
                rows.withColumn("part", F.col("id") % 3), "gold", "t", "f_", partition_by=partition_by
            )
        assert layers.current_version(spark, "gold", "t", "f_") == before
        assert sorted(r[0] for r in layers.read_layer(spark, "gold", "t", "f_").collect()) == list(range(100))
    layers.write_layer(spark.range(7), "gold", "t", "f_")
    assert layers.read_layer(spark, "gold", "t", "f_").count() == 7
    # What the failures left behind goes with the old version.
    layers.drop_old_versions(spark, "gold", "t", "f_", keep=0)
    assert [p.name for p in (tmp_path / "f_gold" / "t").iterdir()] == [
        layers.current_version(spark, "gold", "t", "f_").rsplit("/", 1)[1]
    ]
    assert layers.read_layer(spark, "gold", "t", "f_").count() == 7


def test_a_reader_keeps_its_version(spark, tmp_path):
    layers.ensure_layers(spark, "r_", str(tmp_path))
    old = layers.write_layer(spark.range(4), "gold", "t", "r_")
    layers.write_layer(spark.range(9).selectExpr("id", "'x' AS more"), "gold", "t", "r_")
    assert (old.count(), old.columns) == (4, ["id"])
    assert layers.read_layer(spark, "gold", "t", "r_").columns == ["id", "more"]
    assert len(layers.drop_old_versions(spark, "gold", "t", "r_", keep=1)) == 0
    assert len(layers.drop_old_versions(spark, "gold", "t", "r_", keep=0)) == 1


def test_a_table_replaced_by_itself(spark, tmp_path):
    layers.ensure_layers(spark, "s_", str(tmp_path))
    table = layers.write_layer(spark.range(10), "gold", "t", "s_")
    for _ in range(3):
        table = layers.write_layer(table.where("id > 0").selectExpr("id - 1 AS id"), "gold", "t", "s_")
    assert sorted(r[0] for r in table.collect()) == list(range(7))


def test_partitioned_layers_keep_columns_and_types(spark, tmp_path):
    layers.ensure_layers(spark, "q_", str(tmp_path))
    kind = "day date, a string, code long, n int"
    days = [dt.date(2026, 1, 1), dt.date(2026, 1, 2), None]
    rows = [(days[k % 3], f"a{k % 5}", 7 + k // 20 * 10**12, k) for k in range(30)]
    for given in (rows, [], [(None, "x", None, 1)]):
        df = spark.createDataFrame(given, kind)
        written = layers.write_layer(
            df, "gold", "t", "q_", partition_by=["day", "code"], cluster_by=["a"]
        )
        assert written.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, written.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError, match="whole numbers"):
        layers.write_layer(df, "gold", "t", "q_", partition_by=["a"])


def test_a_foreign_table_is_not_replaced(spark, tmp_path):
    layers.ensure_layers(spark, "o_", str(tmp_path))
    spark.range(3).write.saveAsTable("o_gold.other")
    with pytest.raises(ValueError, match="no layer table"):
        layers.write_layer(spark.range(1), "gold", "other", "o_")
    assert spark.table("o_gold.other").count() == 3


def test_pipeline_layers(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files.write_raw_csv(raw_transactions(spark, SF), raw)
    run = pipeline.run(spark, raw, _rates(spark, SF), "p_", str(tmp_path / "tables"))
    assert {df.count() for df in (run.bronze, run.silver, run.gold)} == {1000}
    # What was observed while writing is what a scan finds.
    observed = {r["layer"]: r["rows"] for r in quality.observed_counts(spark, run.observed).collect()}
    assert observed == {"bronze": 1000, "silver": 1000, "gold": 1000, "alerts": run.alerts.count()}
    nulls = quality.observed_nulls(spark, run.observed["bronze"])
    assert nulls.collect() == quality.null_profile(run.bronze).collect()
    assert sum(nulls.first().asDict().values()) > 0
    fired = reports.flag_totals(run.gold).first().asDict()
    assert {f: run.observed["gold"][f] for f in fired} == fired
    assert run.bronze.columns[-2:] == ["_ingest_ts", "_source_file"]
    names = run.silver.columns
    assert names[0] == "currency_code"
    assert {f"__norm_{c}" for c in TIMESTAMP_COLUMNS} <= set(names)
    assert names[-3:] == ["usd_rate", "amount_usd", "dq_fx_missing"]
    assert [r["tableName"] for r in layers.list_layer(spark, "gold", "p_").collect()] == [
        "transactions_gold", "tx_alerts_gold",
    ]


def test_rates(spark):
    quotes = spark.createDataFrame(
        [("USD", 7.0), ("EUR", 0.8), (" eur ", 0.5), ("BAD", 0.0), ("NEG", -1.0), ("NUL", None),
         (" chf ", 0.5), ("NAN", float("nan")), (None, 2.0)],
        "currency_code string, units_per_usd double",
    )
    got = {r["currency_code"]: r["usd_rate"] for r in rates.fx_rates(quotes).collect()}
    assert got == {"USD": 1.0, "EUR": 1.25, "CHF": 2.0}


@pytest.mark.parametrize("many", [False, True])
def test_conversion_with_few_and_many_rates(spark, settings, many):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    quotes = spark.createDataFrame(
        [("EUR", 1.25), ("USD", 1.0)], "currency_code string, usd_rate double"
    )
    tx = spark.createDataFrame(
        [(1, " eur ", "100.00"), (2, "XXX", "7.00"), (3, None, "8.00"), (4, "USD", None),
         (5, "EUR", "9999999999999999.99")],
        "id int, currency_code string, amount string",
    ).selectExpr("id", "currency_code", "cast(amount AS decimal(18,2)) AS amount_num")
    converted = fx.convert_to_usd(tx, quotes, many_rates=many)
    broadcast = "BroadcastHashJoin" in converted._jdf.queryExecution().executedPlan().toString()
    assert broadcast == (not many)
    assert converted.columns == [
        "currency_code", "id", "amount_num", "usd_rate", "amount_usd", "dq_fx_missing",
    ]
    got = {r["id"]: (r["currency_code"], str(r["amount_usd"]), r["dq_fx_missing"])
           for r in converted.collect()}
    assert got == {
        1: ("EUR", "125.00", 0), 2: ("XXX", "7.00", 1), 3: (None, "8.00", 1),
        4: ("USD", "None", 0), 5: ("EUR", "None", 0),
    }


def test_too_many_rates_to_broadcast_fail_when_read(spark):
    codes = spark.range(50).selectExpr("concat('C', id) AS currency_code", "2.0D AS usd_rate")
    tx = spark.createDataFrame([("C1", "1.00")], "currency_code string, amount string").selectExpr(
        "currency_code", "cast(amount AS decimal(18,2)) AS amount_num"
    )
    assert fx.convert_to_usd(tx, codes, max_rates=50).count() == 1
    converted = fx.convert_to_usd(tx, codes, max_rates=49)  # no job yet
    with pytest.raises(Exception, match="more than 49 rows"):
        converted.collect()


def test_scratch_is_in_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_without_the_setting():
    def session(master):
        return SimpleNamespace(
            conf={}, sparkContext=SimpleNamespace(master=master, applicationId="app")
        )

    local = session("local[2]")
    first, second = scratch_dir(local, "x"), scratch_dir(local, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "x")


def test_shuffles_grow_with_the_input_and_shrink_again(spark, settings):
    settings({"spark.sql.shuffle.partitions": "8"})
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    with sized_for(spark, 1 << 20):
        assert [spark.conf.get(k) for k in keys] == before
    with pytest.raises(ZeroDivisionError), sized_for(spark, 100 << 40):
        assert spark.conf.get(keys[0]) == str((100 << 40) // (4 << 30))
        _ = 1 / 0
    assert [spark.conf.get(k) for k in keys] == before


@pytest.mark.parametrize("size", [0, 1, 10 << 30, 20 << 40, 100 << 40, 1 << 50])
def test_shuffle_blocks_are_bounded(size):
    reducers, split = shuffle_sizes(size)
    assert reducers >= 1 and reducers * -(-size // split) <= 10**9
    assert size <= reducers * (4 << 30)
