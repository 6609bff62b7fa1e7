"""Connected components of an edge list, in rounds of joins that end in a written table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.llm.common import discard, store
from txmon.operators.joins import attach

# Edges that a task contracts at a time.
_CHUNK = 1 << 20


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges with the smallest node it reaches through them."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task as fewer ones with the same components."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> pa.RecordBatch:
        u, v = _forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= _CHUNK:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _each(rows: DataFrame, names: tuple[str, str], *pairs: tuple[str, str]) -> DataFrame:
    """Several pairs of columns of a row, each as a row.

    A union would have what makes the rows once for each pair, and a round's plan, where such
    steps are nested, many times as large; the driver keeps plans.
    """
    each = [F.struct(*(F.col(c).alias(n) for c, n in zip(pair, names, strict=True))) for pair in pairs]
    return rows.select(F.inline(F.array(*each)))


def _smallest(edges: DataFrame, node: str) -> DataFrame:
    """Edges with the smallest of a node's neighbours and itself."""
    least = edges.groupBy(node).agg(F.min("w").alias("least"))
    return attach(edges, least, [node]).withColumn("least", F.least("least", node))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: every node that has an edge, with the smallest node of its component.

    ``edges`` are pairs of longs ``(u, v)`` in any direction, repeated or not; NULLs and loops
    are ignored. Alternates the large-star and small-star steps, each a minimum per node and a
    join that splits hot nodes, until nothing changes.
    """
    now = edges.select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")
    ).filter("u <> v")
    now = store(now.mapInArrow(_contract, "u long, v long").distinct(), "edges")
    state = None
    while True:
        # Larger neighbours are tied to the smallest one.
        both = _each(now, ("n", "w"), ("u", "v"), ("v", "u"))
        large = _smallest(both, "n").filter("w > n").select(
            F.col("w").alias("n"), F.col("least").alias("w")
        ).filter("n <> w").distinct()
        # Smaller neighbours and the node itself are tied to the smallest one.
        small = _smallest(large, "n")
        tied = _each(small, ("u", "v"), ("w", "least"), ("n", "least"))
        before, now = now, store(tied.filter("u <> v").distinct(), "edges")
        discard(before)
        new = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum("v")
        ).first()
        if new == state or new[0] == 0:
            break
        state = new
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)
