"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import math
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Semantics: instants are UTC, casts are strict (so the code must use try_*), and
# timestamp layouts never fall back to the lenient legacy parser.
SEMANTIC_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}

# Physical: runtime re-planning splits hot join partitions and merges small reducers.
PHYSICAL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Eight bytes an instant, not the twelve of Spark's old notation, which are slow to write.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

_REDUCER_BYTES = 4 << 30
_SPLIT_BYTES = 128 << 20
# A shuffle keeps a block for each pair of a map task and a reducer.
_MOST_BLOCKS = 10**9


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings."""
    for key, value in {**SEMANTIC_SETTINGS, **PHYSICAL_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def shuffle_sizes(input_bytes: int) -> tuple[int, int]:
    """``(reducers, bytes of a map task's split)`` for an input of that size.

    AQE only merges small reducers, it never adds any, so the starting number must suit the
    input: some 4 GB each, which sort and spill. Splits grow where there would be more than a
    billion pairs of map task and reducer.
    """
    reducers = max(1, math.ceil(input_bytes / _REDUCER_BYTES))
    split = _SPLIT_BYTES
    while math.ceil(input_bytes / split) * reducers > _MOST_BLOCKS:
        split *= 2
    return reducers, split


@contextlib.contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffles sized for an input while the block runs; never below the settings before it."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {key: spark.conf.get(key) for key in keys}
    reducers, split = shuffle_sizes(input_bytes)
    spark.conf.set(keys[0], str(max(int(before[keys[0]]), reducers)))
    if split > _SPLIT_BYTES:
        spark.conf.set(keys[1], str(split))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in the block leave no shuffle files behind.

    Otherwise they lie on the disks until the driver happens to collect its garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of the files below a path, as the file system knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of files that nothing reads any more."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for written intermediates, in the folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may run
    without the setting; it then gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    run = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/txmon/{run}/{label}-{uuid.uuid4().hex[:12]}"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="txmon-")
