"""Consistent hashing with virtual nodes and bounded loads, in SQL functions only."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import documents, store

SHARDS = 24
VIRTUAL_NODES = 64
# The ring has this many slices; virtual nodes and keys lie on slices.
RING = 1 << 16


def _ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """Virtual nodes clockwise as (slice, shard)."""
    place = lambda s, v: int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[:4], 16)
    return sorted((place(s, v), s) for s in range(shards) for v in range(virtual_nodes))


def _deal(load: list[int], owner: list[int], capacity: list[int]) -> list[tuple[int, ...]]:
    """Places the keys of arc after arc: what a full shard can't take goes on clockwise.

    Returns ``(arc, first, end, shard, slot)``: keys ``first`` to ``end`` of the arc take the
    shard's slots from ``slot`` on. One short pass over the ring, whose size is a parameter.
    """
    filled = [0] * len(capacity)
    pieces = []
    for arc, keys in enumerate(load):
        done, node = 0, arc
        while done < keys:
            shard = owner[node % len(owner)]
            take = min(keys - done, capacity[shard] - filled[shard])
            if take:
                pieces.append((arc, done, done + take, shard, filled[shard]))
                filled[shard] += take
                done += take
            node += 1
    return pieces


def _table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table from a literal."""
    kind = "array<struct<" + ",".join(f"{n}:bigint" for n in names) + ">>"
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def _key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def bounded_ring(
    docs: DataFrame,
    shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, home_shard, shard, slot)`` for every row.

    A row's key is the MD5 of its id. It belongs to the next virtual node clockwise
    (``home_shard``); when that shard is full, it continues clockwise to the next one that is
    not. Capacities add up to the number of rows, so counts differ by one at most. ``slot``
    numbers a shard's rows without gaps. Keys are counted per slice of the ring (65,536),
    ranked inside a slice, and only the counts per arc reach the driver. A NULL id has the key
    of an empty string, a NULL text is empty; repeated rows each get a slot of their own.
    Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _key(F.col(id_col)).alias("key"),
    ).withColumn("slice", F.conv(F.substring("key", 1, 4), 16, 10).cast("long"))

    nodes = _ring(shards, virtual_nodes)
    owner = [shard for _, shard in nodes]
    ends = [place for place, _ in nodes]
    # Arc i ends at node i; what lies past the last node belongs to the first.
    spans = [(i, ends[i - 1] + 1 if i else 0, end) for i, end in enumerate(ends)]
    spans.append((0, ends[-1] + 1, RING - 1))
    # Past the last node first, so that the first arc's keys are in clockwise order.
    arcs = (
        _table(spark, [x for x in spans if x[1] <= x[2]], ["arc", "lo", "hi"])
        .select("arc", F.explode(F.sequence("lo", "hi")).alias("slice"))
        .withColumn("turn", (F.col("slice") - F.lit(ends[-1] + 1) + RING) % RING)
    )
    keys = docs.select(_key(F.col(id_col)).alias("key"))
    slices = keys.groupBy(F.conv(F.substring("key", 1, 4), 16, 10).cast("long").alias("slice"))
    clockwise = Window.partitionBy("arc").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = store(
        slices.agg(F.count("*").alias("n"))
        .join(arcs, "slice")
        .withColumn("before", F.coalesce(F.sum("n").over(clockwise), F.lit(0))),
        "ring-slices",
    )

    load = [0] * len(nodes)
    for arc, n in counted.groupBy("arc").agg(F.sum("n")).collect():  # one row an arc
        load[arc] = n
    low, more = divmod(sum(load), shards)
    pieces = _deal(load, owner, [low + (s < more) for s in range(shards)])
    dealt = _table(spark, pieces, ["arc", "first", "end", "shard", "start"])

    in_slice = Window.partitionBy("slice").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = (
        rows.withColumn("rank", F.row_number().over(in_slice) - 1)
        .join(F.broadcast(counted.select("slice", "arc", "before")), "slice")  # 65,536 rows
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    home = _table(spark, list(enumerate(owner)), ["arc", "home_shard"])
    return (
        ranked.join(F.broadcast(home), "arc")
        .join(F.broadcast(dealt.withColumnRenamed("arc", "of")), F.expr(
            "arc = of AND rank >= first AND rank < end"
        ))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("home_shard").cast("int").alias("home_shard"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("start") + F.col("rank") - F.col("first")).alias("slot"),
        )
    )


def op6_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_ring(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )
