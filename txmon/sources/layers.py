"""Layer tables: one schema per layer, every write replaces the table in one step.

A table is a pointer. Each write goes to a fresh folder, a version that never changes again;
only when it is complete does the table's catalog entry, a view of one folder, move on to it.
So a write that fails leaves the old rows, readers see one version or the other, and a table may
be replaced by what is read from it. Old versions stay until :func:`drop_old_versions`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmon.session import short_shuffles

LAYERS = ("bronze", "silver", "gold")

_PARTITION_TYPES = (T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_VERSION = re.compile(r"/version-(\d{8})-[0-9a-f]{12}$")


def layer_schema(layer: str, prefix: str = "") -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{prefix}{layer}"


def ensure_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> None:
    """Create the layer schemas if missing, below ``location`` or in the warehouse."""
    for layer in LAYERS:
        schema = layer_schema(layer, prefix)
        where = f" LOCATION '{location.rstrip('/')}/{schema}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{where}")


def write_layer(
    df: DataFrame | Sequence[DataFrame],
    layer: str,
    name: str,
    prefix: str = "",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Replace the table and return it as read back, so later steps start from storage.

    Several frames are parts of it and written one after another; the shuffle files of each go
    with its end.

    With ``partition_by`` a value's rows are gathered before they are written, so that a
    folder gets as many files as its size calls for, however many tasks the plan has;
    adaptive execution splits a value with many rows. ``cluster_by`` sorts inside the files.
    No dictionaries: most columns are times and ids, which fill them and are then written
    again without, and the compression finds what the others repeat.
    ``observe`` takes aggregates of what is written in a part, without another scan.
    """
    parts = [df] if isinstance(df, DataFrame) else list(df)
    df = parts[0]
    spark = df.sparkSession
    # Folder names don't tell a text of digits from a number.
    odd = [c for c in partition_by if not isinstance(df.schema[c].dataType, _PARTITION_TYPES)]
    if odd:
        raise ValueError(f"partition columns must be dates or whole numbers: {odd}")
    schema = layer_schema(layer, prefix)
    folder = _folder(spark, schema, name)
    current = current_version(spark, layer, name, prefix)
    number = int(_VERSION.search(current)[1]) + 1 if current else 1
    version = f"{folder}/version-{number:08d}-{uuid.uuid4().hex[:12]}"

    plain = {"parquet.enable.dictionary": "false", "compression": "zstd"}
    for part in parts:
        rows = part.hint("rebalance", *map(F.col, partition_by)) if partition_by else part
        if cluster_by:
            rows = rows.sortWithinPartitions(*partition_by, *cluster_by)
        if observe:
            # In the stage that writes: a map stage repeated for a lost executor counts twice.
            rows = observe(rows)
        with short_shuffles(spark):
            rows.write.mode("append").partitionBy(*partition_by).options(**plain).parquet(version)
    try:
        spark.read.parquet(version)
    except AnalysisException as unreadable:
        if unreadable.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # No rows make no partition folders; an empty file still has the columns.
        df.limit(0).coalesce(1).write.mode("append").parquet(version)

    # Partition columns are read from folder names, as the type that these suggest.
    columns = ", ".join(
        f"CAST({_quoted(f.name)} AS {f.dataType.simpleString()}) AS {_quoted(f.name)}"
        if f.name in partition_by
        else _quoted(f.name)
        for f in df.schema
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS "
        f"SELECT {columns} FROM parquet.{_quoted(version)}"
    )
    return spark.table(f"`{schema}`.`{name}`")


def read_layer(spark: SparkSession, layer: str, name: str, prefix: str = "") -> DataFrame:
    return spark.table(f"`{layer_schema(layer, prefix)}`.`{name}`")


def list_layer(spark: SparkSession, layer: str, prefix: str = "") -> DataFrame:
    """The layer's tables: ``namespace, tableName, isTemporary``."""
    shown = spark.sql(f"SHOW TABLES IN `{layer_schema(layer, prefix)}`")
    return shown.where("NOT isTemporary")


def current_version(
    spark: SparkSession, layer: str, name: str, prefix: str = ""
) -> str | None:
    """The folder a table points to, or None before its first write."""
    table = f"`{layer_schema(layer, prefix)}`.`{name}`"
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'")
    texts = [row["data_type"] for row in described.collect()]  # one row
    found = re.search(r"FROM parquet\.`((?:[^`]|``)+)`$", texts[0]) if texts else None
    if not found or not _VERSION.search(found[1].replace("``", "`")):
        raise ValueError(f"{table} is no layer table; drop or rename it first")
    return found[1].replace("``", "`")


def drop_old_versions(
    spark: SparkSession, layer: str, name: str, prefix: str = "", keep: int = 1
) -> list[str]:
    """Delete versions older than the current one but for the newest ``keep`` of them.

    What a failed write left behind has a number, too, and goes with them. Versions newer than
    the current one may still be being written and stay. Not for use while older versions are
    read. Returns the deleted folders.
    """
    current = current_version(spark, layer, name, prefix)
    if current is None:
        return []
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(current).getParent()
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own = int(_VERSION.search(current)[1])
    name_of = lambda path: f"/{path.getName()}"
    older = sorted(
        (
            path
            for path in (status.getPath() for status in files.listStatus(folder))
            if (match := _VERSION.search(name_of(path)))
            and int(match[1]) <= own
            and not current.endswith(name_of(path))
        ),
        key=name_of,
    )
    # Of one number, a failed write may be beside the current version: it is older, too.
    gone = older[: len(older) - keep] if keep else older
    for path in gone:
        files.delete(path, True)
    return [path.toString() for path in gone]


def _folder(spark: SparkSession, schema: str, name: str) -> str:
    described = spark.sql(f"DESCRIBE SCHEMA `{schema}`").where(F.col("info_name") == "Location")
    return f"{described.first()['info_value'].rstrip('/')}/{name}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
