"""Whitening of embeddings by eigenvectors refined in mixed precision.

1. Entries become integers on a grid, so counts, sums and products are exact and do not depend
   on the order of rows. One pass finds the sums, a second one the products of the vectors,
   centred by the rounded mean; what rounding left is taken off exactly.
2. The covariance is a matrix of the vectors' width, whatever the number of rows. Its
   eigenvectors are found in 32 bits and corrected by Ogita and Aishima's iteration, matrix
   products only, first in 64 bits and then in extended precision. Eigenvalues too close to be
   told apart get a sub-solve: the matrix seen in their subspace, less their mean, is solved
   by itself, where small differences are large.
3. A third pass projects the vectors and stores the result, from which the covariance of the
   whitened vectors is taken as a check.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import store

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8

# Grid values stay below 2**61 in size, so they and differences of them fit 64 bits.
_LARGEST = float(1 << 61)
_LIMB = 42
_CELLS = "i int, j int, low long, mid long, high long"
_STEPS = 40


# --- 1. exact sums ---


def _grid(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, all of one width, as rows of integers."""
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cells(totals: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """Whole numbers of any size in three limbs, which can be added up as longs."""
    low = (1 << _LIMB) - 1
    columns = [
        [i for i, _ in totals],
        [j for _, j in totals],
        [v & low for v in totals.values()],
        [v >> _LIMB & low for v in totals.values()],
        [v >> 2 * _LIMB for v in totals.values()],
    ]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["i", "j", "low", "mid", "high"])


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of integers as Python integers."""
    most = max((int(np.abs(m).max()) for m in (a, b) if m.size), default=0)
    # Doubles hold sums of products below 2**53 exactly, and multiply fast.
    rows = (1 << 53) // (most * most) if most else len(a)
    if rows < 64:
        return a.astype(object).T @ b.astype(object)
    total = np.zeros((a.shape[1], b.shape[1]), dtype=object)
    for at in range(0, len(a), rows):
        part = a[at : at + rows].astype(float).T @ b[at : at + rows].astype(float)
        total += part.astype(np.int64).astype(object)
    return total


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cell (i, 0): the sum of entry i; cell (-1, 0): the number of vectors."""
    totals: dict[tuple[int, int], int] = {}
    for batch in batches:
        x = _grid(batch)
        if not len(x):
            continue
        sums = _exact(x, np.ones((len(x), 1), dtype=np.int64))[:, 0]
        for i, s in [(-1, len(x)), *enumerate(sums)]:
            totals[i, 0] = totals.get((i, 0), 0) + int(s)
    yield _cells(totals)


def _products(center: np.ndarray):
    """Cell (i, j), i <= j: the sum of products of centred entries."""
    upper = [(i, j) for i in range(len(center)) for j in range(i, len(center))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(center), len(center)), dtype=object)
        for batch in batches:
            y = _grid(batch) - center
            total += _exact(y, y)
        yield _cells({(i, j): int(total[i, j]) for i, j in upper})

    return run


def _added(rows: DataFrame, function) -> dict[tuple[int, int], int]:
    """Cells of all tasks added up; their number depends on the vectors' width only."""
    limbs = ("low", "mid", "high")
    cells = rows.mapInArrow(function, _CELLS).groupBy("i", "j")
    return {
        (r["i"], r["j"]): r["low"] + (r["mid"] << _LIMB) + (r["high"] << 2 * _LIMB)
        for r in cells.agg(*(F.sum(c).alias(c) for c in limbs)).collect()
    }


# --- 2. eigenvectors ---


def refined_eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of extended precision.

    Starts from 32-bit eigenvectors. With ``R = I - X'X`` and ``S = X'AX`` the correction is
    ``E_ij = (S_ij + l_j R_ij) / (l_j - l_i)``, or ``R_ij / 2`` where the difference of the
    eigenvalues is within the error. Such clusters are solved in their own subspace and
    corrected again; exactly equal eigenvalues keep some basis of theirs. Each eigenvector's
    largest entry is positive.
    """
    wide = np.longdouble
    a = np.asarray(a, dtype=wide)
    size = float(np.abs(a).max(initial=0)) or 1.0
    a = a / wide(size)
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = _corrected(a.astype(float), start.astype(float), 2)[1]
    values, x = _corrected(a, x.astype(wide), _STEPS)
    x = _orthonormal(x)
    order = np.argsort(-values, kind="stable")
    values, x = values[order] * wide(size), x[:, order]
    top = np.abs(x).argmax(axis=0)
    return values, x * np.sign(x[top, np.arange(x.shape[1])])


def _corrected(a: np.ndarray, x: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    tiny = np.finfo(a.dtype).eps
    least = np.inf
    values = np.zeros(len(a), dtype=a.dtype)
    for _ in range(steps):
        values, change, close = _correction(a, x)
        x = x + x @ change
        spread = 0.0
        for cluster in _clusters(values, close):
            x, turned = _subsolve(a, x, cluster)
            spread = max(spread, turned)
        moved = max(float(np.abs(change).max(initial=0)), spread)
        # Converged, or as good as the precision lets it be.
        if moved <= 4 * tiny or (moved >= least / 2 and moved < 1e3 * tiny * len(a)):
            break
        least = min(least, moved)
    values, change, _ = _correction(a, x)
    return values, x + x @ change


def _correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, the relative correction, and the distance that can't be told apart."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    close = 2 * float(np.sqrt((off * off).sum()) + np.sqrt((a * a).sum()) * np.sqrt((r * r).sum()))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > close
    safe = np.where(apart, gaps, 1)
    return values, np.where(apart, (s + values[None, :] * r) / safe, r / 2), close


def _clusters(values: np.ndarray, close: float) -> Iterator[np.ndarray]:
    """Places of eigenvalues that hang together by steps of at most ``close``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > close) + 1
    yield from (part for part in np.split(order, cuts) if len(part) > 1)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Vectors that are nearly orthonormal, made so to working precision."""
    for _ in range(2):
        x = x + x @ ((np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2)
    return x


def _subsolve(a: np.ndarray, x: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, float]:
    """Turns a cluster's vectors to the eigenvectors of the matrix seen in their subspace."""
    own = _orthonormal(x[:, cluster])
    mean = np.trace(own.T @ (a @ own)) / len(cluster)
    seen = own.T @ (a @ own - mean * own)
    seen = (seen + seen.T) / 2
    largest = float(np.abs(seen).max())
    # Nothing but rounding: the eigenvalues are equal, and any basis will do.
    if largest <= 8 * len(a) * float(np.finfo(a.dtype).eps) * float(np.abs(a).max()):
        turned, by = own, 0.0
    else:
        _, basis = np.linalg.eigh((seen / largest).astype(float))
        turned = own @ basis.astype(a.dtype)
        off = np.abs(seen - np.diag(np.diag(seen))).max()
        by = float(off) / largest
    x = x.copy()
    x[:, cluster] = turned
    return x, by


# --- 3. fit and transform ---


@dataclass(frozen=True)
class Whitening:
    """Count, sums per entry, and the leading components of a list of grid vectors."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # a row for each component
    values: np.ndarray
    explained: np.ndarray

    @property
    def center(self) -> np.ndarray:
        return np.array([_nearest(s, self.n) for s in self.sums], dtype=np.int64)


def _nearest(a: int, n: int) -> int:
    return (2 * a + n) // (2 * n) if n else 0


def on_grid(
    vectors: DataFrame,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """``(vec_id, x)``: vectors as ``floor(scale * entry) + offset``.

    A vector that is NULL or has NULL or non-finite entries is dropped, as is one whose grid
    values would not fit a long. So are vectors of another width than the commonest one (the
    largest of equally common ones) and empty ones. Rows may repeat; their id may be NULL.
    """
    entry = lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < _LARGEST)
    given = F.col(vector_col)
    kept = vectors.filter(given.isNotNull() & (F.size(given) > 0) & F.forall(given, fine)).select(
        F.col(id_col).alias("vec_id"), given.alias("__vector")
    )
    widths = kept.groupBy(F.size("__vector").alias("width")).agg(F.count("*").alias("n"))
    common = widths.orderBy(F.desc("n"), F.desc("width")).first()
    width = common["width"] if common else 0
    return kept.filter(F.size("__vector") == width).select(
        "vec_id", F.transform("__vector", entry).alias("x")
    )


def fit(grid: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The leading components of the covariance (divisor n) of all vectors.

    Components without variance can't be whitened and are left out.
    """
    sums = _added(grid.select("x"), _sums)
    n = sums.pop((-1, 0), 0)
    total = tuple(sums[i, 0] for i in range(len(sums)))
    if not n:
        none = np.zeros(0)
        return Whitening(0, (), none.reshape(0, 0), none, none)
    center = np.array([_nearest(s, n) for s in total], dtype=np.int64)
    products = _added(grid.select("x"), _products(center))
    rest = [s - n * int(c) for s, c in zip(total, center, strict=True)]
    width = len(total)
    covariance = np.zeros((width, width), dtype=np.longdouble)
    for (i, j), p in products.items():
        # Exactly n squared times the covariance, then rounded once to extended precision.
        covariance[i, j] = covariance[j, i] = _long(Fraction(n * p - rest[i] * rest[j], n * n))
    values, vectors = refined_eigenvectors(covariance)
    trace = values.sum()
    floor = width * np.finfo(np.float64).eps * max(values.max(), np.longdouble(0))
    keep = np.flatnonzero(values > floor)[:components]
    return Whitening(
        n,
        total,
        vectors[:, keep].T.astype(float),
        values[keep].astype(float),
        (values[keep] / trace).astype(float) if len(keep) else np.zeros(0),
    )


def _long(value: Fraction) -> np.longdouble:
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def transform(grid: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened)``: one number for each component.

    ``deviation`` is the exact sum over entries of ``(n * x - sum) ** 2``, as a decimal.
    """
    center = model.center
    rest = [s - model.n * int(c) for s, c in zip(model.sums, center, strict=True)]
    shift = np.array([s / model.n for s in rest]) if model.n else np.zeros(0)
    scaled = model.vectors.T / np.sqrt(model.values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _grid(batch) - center
            white = (y - shift) @ scaled
            fit_ints = int(np.abs(y).max(initial=0)) * model.n + max(map(abs, rest), default=0)
            wide = y if fit_ints * fit_ints * max(1, len(center)) < 1 << 62 else y.astype(object)
            off = wide * model.n - np.array(rest, dtype=wide.dtype)
            deviation = (off * off).sum(axis=1).tolist()
            ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([str(d) for d in deviation], pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    kind = grid.schema["vec_id"].dataType.simpleString()
    found = grid.mapInArrow(run, f"vec_id {kind}, deviation string, whitened array<double>")
    return found.withColumn("deviation", F.expr("try_cast(deviation AS decimal(38,0))"))


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest difference of the whitened vectors' covariance from the identity."""
    k = len(model.values)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    entry = lambda i: F.get("whitened", F.lit(i))
    sums = whitened.agg(
        *(F.sum(entry(i)) for i in range(k)), *(F.sum(entry(i) * entry(j)) for i, j in pairs)
    ).first()
    mean = [s / model.n for s in sums[:k]]
    return max(
        abs(s / model.n - mean[i] * mean[j] - (i == j))
        for (i, j), s in zip(pairs, sums[k:], strict=True)
    )


def whiten(vectors: DataFrame, components: int = COMPONENTS, **grid) -> DataFrame:
    """One row for each kept vector and component, numbered from 1 by falling eigenvalue.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``. See
    :func:`on_grid` for what is dropped; repeated rows count as often as they occur. Vectors
    that are all equal, or a single one, have no variance and give no rows, nor does an empty
    table. Other columns are ignored.
    """
    rows = on_grid(vectors, **grid)
    model = fit(rows, components)
    stored = store(transform(rows, model), "whitened")
    error = identity_error(stored, model) if len(model.values) else 0.0
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    return stored.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op11_mixed_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query's ``deviation`` is a long, NULL where it does not fit one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(vectors).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
