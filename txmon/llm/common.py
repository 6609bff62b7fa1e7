"""What several operators share: bound expressions, stored intermediates, id filters."""

from __future__ import annotations

import contextlib
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.session import delete_folder, scratch_dir, short_shuffles

# The white space of the word rule: space and 0x09 to 0x0D.
WORD_SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# An id filter is a bitmap of this many bits (2 MB), whatever the number of ids.
_FILTER_BITS = 1 << 24


def ship_code(spark: SparkSession) -> None:
    """Sends this package to Python workers that would not find it by themselves.

    Where it is installed, on PYTHONPATH or in the working folder, there is nothing to do.
    """
    root = Path(__file__).resolve().parents[2]
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    context = spark.sparkContext
    if any(p and Path(p).resolve() == root for p in known) or "site-packages" in root.parts:
        return
    if any("txmon-code" in f for f in context.listFiles):
        return
    # The driver serves the file from here as long as it runs.
    path = Path(tempfile.mkdtemp(prefix="txmon-"), f"txmon-code-{context.applicationId}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.glob("txmon/**/*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(str(path))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; ``lower`` does the same faster where all characters are ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


# Where stored tables lie, as long as they are known.
_stored: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def store(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once in the shared scratch folder and reads it back.

    The columns are known: looking them up in the files would be a job more for each table.
    """
    return store_each([df], label)


def store_each(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """As :func:`store`, of one part after another; the shuffles of a part go with its end."""
    path, schema = "", None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or scratch_dir(spark, label)
        with short_shuffles(spark):
            df.write.mode("append").parquet(path)
    read = spark.read.schema(schema).parquet(path)
    _stored[read] = path
    return read


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for table in tables:
        if path := _stored.pop(table, None):
            delete_folder(table.sparkSession, path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer whole texts at a time in Python workers, for what is stored in the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def may_be_in(ids: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test for ids that lets all of ``key`` pass and few others.

    It is a bitmap of fixed size; with very many ids more others pass, never fewer ids.
    """
    slot = lambda column: F.pmod(F.xxhash64(column.cast("long")), F.lit(_FILTER_BITS))
    words = (
        ids.select(slot(F.col(key)).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(_FILTER_BITS >> 6, dtype=np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    # A query of one value, which tasks get with their code: no Python worker beside those that
    # a task has anyway, and no rows that wait for it.
    table = pa.table({"words": pa.array([bitmap.view(np.int64)], pa.list_(pa.int64()))})
    held = ids.sparkSession.createDataFrame(table)

    def possible(column: Column) -> Column:
        at = slot(column)
        word = F.get(held.scalar(), F.shiftright(at, 6).cast("int"))
        return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return possible


def only_ids(
    df: DataFrame,
    column: str,
    ids: DataFrame,
    key: str,
    made: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``key`` of ``ids``, moving few others.

    What is ``made`` of them, which has the column, moves instead: a digest rather than a text.
    """
    wanted = ids.select(F.col(key).alias("__wanted")).distinct()
    return made(df.filter(may_be_in(ids, key)(F.col(column)))).join(
        wanted, F.col(column).eqNullSafe(F.col("__wanted")), "left_semi"
    )
