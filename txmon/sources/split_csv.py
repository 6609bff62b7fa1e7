"""Large CSV files read by many tasks, records with line breaks included.

Where a record begins depends on every quote before it, which is why a multi-line file is
usually read by one task. But only the parity of that number matters, and parities add up:

1. Each byte block of a file counts its quotes. Running sums over a file's blocks say whether
   a block begins inside a quoted field.
2. With that, each block finds its own records: a line ends one where the parity is even.
   Records stay in the task; nothing is shuffled.
3. Only records that cross a block's edge are put together from their parts.

Files are told apart by their header: columns are taken by name, so files with columns in
another order, more of them or fewer can be read together.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_DIALECT = {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
_PIECES = "name string, block long, kind int, first boolean, value string"
# What a piece is: a record, the end of one, a part from its middle, the beginning of one.
_RECORD, _END, _MIDDLE, _BEGIN = range(4)


def read_split_csv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The records of all files as strings, and ``_source_file``.

    Without ``columns`` there are all names of all headers, in the order of their first
    occurrence by file name; a file without a column has NULLs there. Quotes enclose whole
    fields and are doubled inside; a record with a quote elsewhere fails the read, as its line
    breaks can't be told from others (``files.read_raw_csv`` reads such files, each in one
    task). Lines end with ``\\n`` or ``\\r\\n``; blank ones are skipped; empty fields are NULL.
    Missing fields at the end of a record are NULL, surplus ones are dropped.
    """
    lines = _lines(spark, path)
    blocks = _blocks(lines)
    files = sorted({(name, file) for name, file, *_ in blocks})
    if len({file for _, file in files}) < len(files):
        raise ValueError("two file names have the same hash; read them apart")

    inside, crossed = _inside(blocks)
    lines = lines.drop("name")
    names = {file: name for name, file in files}
    pieces = _pieces(inside, names)
    whole = lines.mapInArrow(pieces, _PIECES).filter(F.col("kind") == _RECORD)
    records = whole.filter(~F.col("first")).select("name", "value")
    if inside:
        # Only blocks at whose edges a record is cut are looked at again.
        cut = lines.filter(F.struct("file", "block").isin([_key(*k) for k in sorted(crossed)]))
        records = records.unionByName(_joined(cut.mapInArrow(pieces, _PIECES)))
    records = _checked(records)

    by_header: dict[tuple[str, ...], list[str]] = {}
    for name, header in sorted((n, h) for n, _, _, _, h in blocks if h is not None):
        by_header.setdefault(_header(header), []).append(name)
    wanted = columns if columns is not None else list(dict.fromkeys(c for h in by_header for c in h))
    parsed = [
        _parsed(records.filter(F.col("name").isin(own)) if len(by_header) > 1 else records, h, wanted)
        for h, own in by_header.items()
    ]
    if not parsed:
        kinds = [T.StructField(c, T.StringType()) for c in (*wanted, "_source_file")]
        return spark.createDataFrame([], T.StructType(kinds))
    return reduce(DataFrame.unionByName, parsed)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    name = F.col("_metadata.file_path")
    return spark.read.text(path, lineSep="\n").select(
        "value",
        name.alias("name"),
        F.xxhash64(name).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _blocks(lines: DataFrame) -> list[tuple]:
    """``(name, file, block, quotes, header)``: a row for each byte block, header in the first.

    No more than the file splits, which Spark's driver lists for every scan.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    said = (F.col("block") == 0) & ~F.col("value").isin("", "\r")
    header = F.min_by(F.when(said, F.col("value")), F.when(said, F.col("row")))
    placed = lines.withColumn("row", F.monotonically_increasing_id())
    found = placed.groupBy("name", "file", "block").agg(
        F.sum(quotes).alias("quotes"), header.alias("header")
    )
    return [tuple(r) for r in found.collect()]


def _inside(blocks: list[tuple]) -> tuple[frozenset, set]:
    """Blocks that begin inside a quoted field; and those with a part of a cut record."""
    inside, crossed = set(), set()
    by_file: dict[int, list] = {}
    for _, file, block, quotes, _ in blocks:
        by_file.setdefault(file, []).append((block, quotes))
    for file, own in by_file.items():
        total, before = 0, None
        for block, quotes in sorted(own):
            if total % 2:
                inside.add((file, block))
                crossed |= {(file, before), (file, block)}
            total += quotes
            before = block
        if total % 2:  # a record that never ends
            crossed.add((file, before))
            inside.add((file, -1))
    return frozenset(inside), crossed


def _key(file: int, block: int) -> Column:
    return F.struct(F.lit(file).cast("long").alias("file"), F.lit(block).cast("long").alias("block"))


class _Block:
    """Cuts the lines of a block, which come in order, into records."""

    def __init__(self, name: str, block: int, inside: bool) -> None:
        self.name, self.block = name, block
        self.parity = int(inside)
        self.open: list[str] = []
        self.before = inside  # nothing but the rest of an earlier block's record so far
        self.first = block == 0

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.count_substring(lines, '"').to_numpy()
        ends = np.flatnonzero((np.cumsum(quotes) + self.parity) % 2 == 0)
        if len(quotes):
            self.parity = (self.parity + int(quotes.sum())) % 2
        if not len(ends):
            self.open += lines.to_pylist()
            return
        cuts = np.append(0, ends + 1).astype(np.int32)
        done = lines.slice(0, int(cuts[-1]))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), done), "\n")
        if self.open:
            head = "\n".join([*self.open, joined[0].as_py()])
            joined = pa.concat_arrays([pa.array([head], pa.string()), joined.slice(1)])
        self.open = lines.slice(int(cuts[-1])).to_pylist()
        if self.before:
            yield self._batch(joined.slice(0, 1), _END)
            joined = joined.slice(1)
            self.before = False
        yield from self._records(joined)

    def _records(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        values = values.filter(pc.invert(pc.is_in(values, pa.array(["", "\r"]))))
        if self.first and len(values):
            yield self._batch(values.slice(0, 1), _RECORD, True)
            values = values.slice(1)
            self.first = False
        yield self._batch(values, _RECORD)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            value = pa.array(["\n".join(self.open)], pa.string())
            yield self._batch(value, _MIDDLE if self.before else _BEGIN, self.first)

    def _batch(self, values: pa.Array, kind: int, first: bool = False) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(self.name, pa.string()), n),
                pa.array(np.full(n, self.block, dtype=np.int64)),
                pa.array(np.full(n, kind, dtype=np.int32)),
                pa.array(np.full(n, first, dtype=bool)),
                values,
            ],
            ["name", "block", "kind", "first", "value"],
        )


def _pieces(inside: frozenset, names: dict[int, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Block | None = None
        place = None
        for batch in batches:
            lines, files, blocks = (
                batch.column(batch.schema.get_field_index(c)) for c in ("value", "file", "block")
            )
            files, blocks = files.to_numpy(), blocks.to_numpy()
            new = (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(files)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                key = int(files[lo]), int(blocks[lo])
                if now is None or place != key:
                    if now is not None:
                        yield from now.end()
                    now, place = _Block(names[key[0]], key[1], key in inside), key
                yield from now.add(lines.slice(lo, hi - lo))
        if now is not None:
            yield from now.end()

    return run


def _joined(pieces: DataFrame) -> DataFrame:
    """Records put together from the parts in several blocks; at most two parts a block."""
    # A block's end or middle part comes before the beginning of another record.
    so_far = Window.partitionBy("name").orderBy("block", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    part = F.struct("block", "kind", "value")
    return (
        pieces.filter(F.col("kind") != _RECORD)
        .withColumn("start", F.max(F.when(F.col("kind") == _BEGIN, F.col("block"))).over(so_far))
        .groupBy("name", "start")
        .agg(F.sort_array(F.collect_list(part)).alias("parts"), F.max("first").alias("first"))
        .filter(~F.col("first"))
        .select("name", F.array_join(F.col("parts.value"), "\n").alias("value"))
    )


def _checked(records: DataFrame) -> DataFrame:
    """Records without the end of their line; a quote out of place fails."""
    value = F.regexp_replace("value", "\r$", "")
    bare = F.replace("value", F.lit('""'), F.lit(""))
    left = F.regexp_replace(bare, '(^|,)"[^"]*+"(?=,|$)', "$1")
    wrong = F.contains("value", F.lit('"')) & F.contains(left, F.lit('"'))
    message = F.concat(F.lit("a quote is neither at the edge of a field nor doubled: "), F.left("value", F.lit(200)))
    return records.withColumn("value", value).withColumn(
        "value", F.when(wrong, F.raise_error(message).cast("string")).otherwise(F.col("value"))
    )


def _header(line: str) -> tuple[str, ...]:
    if line.count('"') % 2:
        raise ValueError(f"a header goes over several lines: {line[:200]}")
    names = next(csv.reader([line.removesuffix("\r").removeprefix("\ufeff")]))
    named = tuple(name or f"_c{place}" for place, name in enumerate(names))
    if len(set(named)) < len(named):
        raise ValueError(f"a header repeats a name: {line[:200]}")
    return named


def _parsed(records: DataFrame, header: tuple[str, ...], names: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"{_quoted(name)} string" for name in header)
    row = F.from_csv("value", schema, _DIALECT).alias("row")
    wanted = (
        F.col(f"row.{_quoted(c)}").alias(c) if c in header else F.lit(None).cast("string").alias(c)
        for c in names
    )
    return records.select("name", row).select(*wanted, F.col("name").alias("_source_file"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
