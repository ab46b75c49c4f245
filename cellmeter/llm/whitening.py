"""Whitening of embeddings: their main directions, scaled to variance one.

Rows are centred and reduced by QR, block by block, to one triangle with the same
covariance; the covariance itself is never formed, so small variances keep their
digits. A few triangles at a time meet in one task until one is left. Its
singular values and vectors come from ``bidiagonal``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..staging import stage
from .bidiagonal import negligible, right_singular

COMPONENTS = 4

# Rows that one QR step takes, and triangles that meet in one task.
_BLOCK_ROWS = 4096
_FAN = 16

# Entries become whole numbers of 1/256; any beyond this take no part.
_STEPS = 256
_LARGEST = 2.0**62

_EXACT = DecimalType(38, 0)


@dataclass(frozen=True)
class Whitening:
    """Fit of the distinct vectors: their number, sums by dimension, directions and variances."""

    count: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / count`` by rows, the whole parts taken off first."""
        whole = np.array([s // self.count for s in self.sums], np.int64)
        part = np.array([(s % self.count) / self.count for s in self.sums])
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((count * x - sums) ** 2)`` by rows, exactly; None beyond 64 bits."""
        whole = np.array([s // self.count for s in self.sums], np.int64)
        part = np.array([s % self.count for s in self.sums], np.int64)
        # count * x - sums is count * (x - whole) - part.
        bound = (self.count * (int(np.abs(x - whole).max(initial=0)) + 1)) ** 2 * max(x.shape[1], 1)
        if bound < 2**63:
            off = self.count * (x - whole) - part
            return (off * off).sum(axis=1).tolist()
        rows = [sum((self.count * v - s) ** 2 for v, s in zip(r, self.sums)) for r in x.tolist()]
        return [d if d < 2**63 else None for d in rows]


def whole_vector(vector: Column) -> Column:
    """``floor(256 * c)`` of every entry, as long; NULL where the vector takes no part.

    That is a NULL vector and one with a NULL or non-finite entry, or with an
    entry whose whole number is beyond 62 bits.
    """
    entry = lambda c: c.cast("double") * float(_STEPS)
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(entry(c)) < _LARGEST, F.lit(False)))
    return F.when(fits, F.transform(vector, lambda c: F.floor(entry(c)).cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension, added up in each task first."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            count += len(x)
            fits = int(np.abs(x).max(initial=0)) * len(x) < 2**63
            total = total + (x if fits else x.astype(object)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(width), pa.int32()),
                pa.array([count] * width, pa.int64()),
                pa.array([str(t) for t in total]),
            ],
            ["place", "n", "total"],
        )

    sums = fit.mapInArrow(partial, "place int, n bigint, total string").groupBy("place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast(_EXACT)).alias("total")
    )
    rows = sorted(sums.collect())
    return rows[0].n, [int(r.total) for r in rows]


def _triangle(blocks: Iterator[np.ndarray], width: int) -> np.ndarray:
    """The triangle of all rows of the blocks."""
    triangle = np.zeros((0, width))
    for rows in blocks:
        triangle = np.linalg.qr(np.concatenate([triangle, rows]), "r")
    return triangle


def _reduced(fit: DataFrame, width: int, centred) -> np.ndarray:
    """Triangle ``R`` with ``R.T @ R`` the products of all centred rows.

    Each task gives one, and ``_FAN`` of them meet at a time.
    """
    schema = "place bigint, r binary"

    def row(place: int, triangle: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([place], pa.int64()), pa.array([triangle.tobytes()], pa.binary())], ["place", "r"]
        )

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (
            centred(_matrix(batch.column(0).slice(begin, _BLOCK_ROWS), width))
            for batch in batches
            for begin in range(0, batch.num_rows, _BLOCK_ROWS)
        )
        triangle = _triangle(blocks, width)
        if len(triangle):
            yield row(0, triangle)

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = (np.frombuffer(r.as_py()) for batch in batches for r in batch.column("r"))
        triangle = _triangle((r.reshape(-1, width) for r in stored), width)
        if len(triangle):
            yield row(0, triangle)

    found = stage(fit.mapInArrow(of_rows, schema).withColumn("place", F.monotonically_increasing_id()), "triangles")
    left = found.count()
    while left > 1:
        groups = -(-left // _FAN)
        dealt = found.repartition(groups, F.pmod(F.hash("place"), F.lit(groups)))
        merged = dealt.mapInArrow(of_triangles, schema).withColumn("place", F.monotonically_increasing_id())
        found = stage(merged, "triangles")
        left = found.count()
    stored = found.first()
    triangle = np.frombuffer(stored.r).reshape(-1, width) if stored else np.zeros((0, width))
    return np.concatenate([triangle, np.zeros((max(width - len(triangle), 0), width))])


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the rows of ``fit``, a stored table of distinct ``x``; None without rows.

    Only triangles as wide as a vector come to the driver. Directions without
    variance aren't components.
    """
    row = fit.select(F.size("x").alias("width")).first()
    if row is None:
        return None
    width, none = row.width, np.zeros(0)
    if not width:
        return Whitening(fit.count(), [], np.zeros((0, 0)), none, none)
    count, sums = _sums(fit, width)
    start = Whitening(count, sums, np.zeros((width, 0)), none, none)
    triangle = _reduced(fit, width, start.centred)
    values, vectors = right_singular(triangle)
    kept = min(components, int((values > negligible(values)).sum()))
    variances = values**2 / count
    return Whitening(
        count, sums, vectors[:, :kept], variances[:kept], variances[:kept] / max(variances.sum(), 1e-300)
    )


def identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """Largest entry by which the covariance of the whitened fit rows misses the identity."""
    width, kept = len(fitted.sums), len(fitted.variances)
    if not kept:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(kept), np.zeros((kept, kept))
        for batch in batches:
            w = fitted.whitened(_matrix(batch.column(0), width))
            total += w.sum(axis=0)
            product += w.T @ w
        values = np.concatenate([total, product.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array(values)], ["place", "value"]
        )

    rows = fit.mapInArrow(moments, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = np.zeros(kept + kept * kept)
    for r in rows.collect():
        found[r.place] = r.value
    mean = found[:kept] / fitted.count
    covariance = found[kept:].reshape(kept, kept) / fitted.count - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(kept)).max())


def whitened(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Every row's whitened components, fitted on each distinct whole-number vector once.

    ``vec_id, component`` (from 1, by falling variance), ``n`` (vectors of the
    fit), ``deviation`` (sum over dimensions of ``(n * x - sum) ** 2``, exact;
    NULL beyond 64 bits), ``whitened``, ``explained`` (share of the variance) and
    ``identity_error``.

    Rows whose vector is NULL or holds NULL or non-finite entries are left out,
    and so are those of another length than most (of equally many, the longer).
    Repeated rows stay repeated, a NULL id stays NULL, other columns are not
    read. There are as many components as directions with variance, 4 at most,
    so one distinct vector alone gives no row, as an empty table does.
    """
    spark = embeddings.sparkSession
    id_field = embeddings.schema[id_col].dataType.simpleString()
    schema = (
        f"vec_id {id_field}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    valid = embeddings.select(F.col(id_col).alias("vec_id"), whole_vector(F.col(vector_col)).alias("x"))
    valid = valid.filter(F.col("x").isNotNull())
    lengths = valid.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    rows = valid.filter(F.size("x") == most.width)
    fit = stage(rows.select("x").distinct(), "distinct_vectors")
    fitted = fit_whitening(fit, components)
    width, kept = most.width, len(fitted.variances)
    if not kept:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, fitted)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            w = fitted.whitened(x)
            size = len(x) * kept
            which = pa.array(np.repeat(np.arange(len(x)), kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(which),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, fitted.count, np.int64)),
                    pa.array(fitted.deviations(x), pa.int64()).take(which),
                    pa.array(w.ravel()),
                    pa.array(np.tile(fitted.explained, len(x))),
                    pa.array(np.full(size, error)),
                ],
                [name.split()[0] for name in schema.split(", ")],
            )

    return rows.mapInArrow(project, schema)
