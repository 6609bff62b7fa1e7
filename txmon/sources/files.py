"""Raw transaction files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes inside a quoted field are doubled, and a field may span lines.
_DIALECT = {"header": True, "quote": '"', "escape": '"'}


def read_raw_csv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Read raw files as strings; malformed records are kept with missing fields NULL.

    A file is read by one task, and all must have the same header: columns are taken by
    place, so a file with other names, or in another order, fails the read. Large files and
    files with different headers are what ``split_csv.read_split_csv`` is for. Naming the
    header's ``columns`` saves the extra job that looks them up.
    """
    reader = spark.read.options(
        **_DIALECT, multiLine=True, mode="PERMISSIVE", enforceSchema=False
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def write_raw_csv(df: DataFrame, path: str, records_per_file: int = 100_000) -> None:
    """Write strings in the dialect :func:`read_raw_csv` reads, blanks kept as they are.

    A reader task takes a whole file, so the records per file are limited.
    """
    df.write.options(
        **_DIALECT,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=records_per_file,
    ).mode("errorifexists").csv(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Stamp each row with the time of ingestion and the file it came from."""
    known = "_source_file" in df.columns
    file = F.col("_source_file") if known else F.col("_metadata.file_path")
    return df.select(
        *(F.col(f"`{c}`") for c in df.columns if c != "_source_file"),
        F.current_timestamp().alias("_ingest_ts"),
        file.alias("_source_file"),
    )
