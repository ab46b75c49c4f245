"""Nearest neighbours along shifted space-filling curves.

Vectors are projected at random, shifted, and ordered along a Hilbert curve,
several times anew. Near vectors tend to be near on some curve: a query is
compared with a window of rows around its place on each, by exact inner
products, and the best of all curves are its neighbours. Each curve is range
partitioned and cut into blocks; a group of work is one block of candidates and
the queries whose windows reach into it.

Inner products are not distances. So vectors get one more coordinate that brings
all to the length of the longest; a query gets 0 there. Then the nearest on the
sphere is the one with the largest product.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .groups import by_group

NEIGHBOURS = 20
CURVES = 16
DIMENSIONS = 6
BITS = 5
# Rows of a window as a share of all, and at least so many on each side. In vectors
# without a structure of few dimensions a curve keeps little of what is near, and
# only large windows find it; where there is one, a small share does.
WINDOW_SHARE = 0.07
LEAST_REACH = 512
SEED = 20

# Exact products are computed for all within this of the approximate least kept.
_SLACK = 1e-9
_SALTS = 32


def usable(vector: Column) -> Column:
    """Not NULL, no component NULL or not finite, not all zero."""
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell numbers along the Hilbert curve of its dimensions.

    Goes down the levels of the curve: at each, the bits of the cell, turned by
    the orientation so far, say which of the 2^d parts it is in (by Gray code),
    and the part says how the orientation goes on.
    """
    n, d = cells.shape
    full = (1 << d) - 1
    entry, direction = np.zeros(n, np.int64), np.zeros(n, np.int64)
    key = np.zeros(n, np.int64)
    weights = np.int64(1) << np.arange(d, dtype=np.int64)

    def turned_right(x: np.ndarray, by: np.ndarray) -> np.ndarray:
        return ((x >> by) | (x << (d - by))) & full

    def turned_left(x: np.ndarray, by: np.ndarray) -> np.ndarray:
        return ((x << by) | (x >> (d - by))) & full

    def low_ones(x: np.ndarray) -> np.ndarray:
        """Number of ones at the low end."""
        count = np.zeros(n, np.int64)
        run = np.ones(n, bool)
        for i in range(d):
            run &= (x >> i) & 1 == 1
            count += run
        return count

    for level in range(bits - 1, -1, -1):
        corner = (((cells >> level) & 1) * weights).sum(axis=1)
        gray = turned_right(corner ^ entry, (direction + 1) % d)
        part = gray.copy()
        shift = 1
        while shift < d:
            part ^= part >> shift
            shift *= 2
        key = (key << d) | part
        # Entry corner and direction of the curve inside that part.
        before = np.maximum((part - 1) // 2 * 2, 0)
        first = np.where(part == 0, 0, before ^ (before >> 1))
        along = np.where(
            part == 0, 0, np.where(part % 2 == 0, low_ones(part - 1), low_ones(part))
        ) % d
        entry = entry ^ turned_left(first, (direction + 1) % d)
        direction = (direction + along + 1) % d
    return key


class Curves:
    """Keys of vectors and queries along each of several curves."""

    def __init__(
        self,
        size: int,
        longest: float,
        curves: int = CURVES,
        dimensions: int = DIMENSIONS,
        bits: int = BITS,
        seed: int = SEED,
    ):
        random = np.random.default_rng(seed)
        self._longest, self._bits, self._scale = longest, bits, np.sqrt(size)
        self._turns = [
            np.linalg.qr(random.normal(size=(size + 1, min(dimensions, size + 1))))[0]
            for _ in range(curves)
        ]
        self._shifts = [random.random(t.shape[1]) for t in self._turns]

    def _keys(self, points: np.ndarray) -> list[np.ndarray]:
        out = []
        for turn, shift in zip(self._turns, self._shifts):
            # Projections of directions are about normal; a logistic curve spreads them.
            even = 1.0 / (1.0 + np.exp(-1.702 * self._scale * (points @ turn)))
            cells = np.floor(even * (1 << self._bits) + shift).astype(np.int64)
            out.append(hilbert_keys(cells % (1 << self._bits), self._bits))
        return out

    def of_vectors(self, vectors: np.ndarray) -> list[np.ndarray]:
        scaled = vectors / self._longest
        rest = np.sqrt(np.maximum(1.0 - (scaled**2).sum(axis=1), 0.0))
        return self._keys(np.column_stack([scaled, rest]))

    def of_queries(self, vectors: np.ndarray) -> list[np.ndarray]:
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        return self._keys(np.column_stack([unit, np.zeros(len(unit))]))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``rep, vector, ids, is_query``: each distinct vector with the ``keep`` least of its ids.

    More are never among the neighbours of anything.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)))
    for keys in (["vector", "_salt"], ["vector"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        salted = salted.withColumn("_place", place).filter(F.col("_place") <= keep)
    ids = salted.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.groupBy("vector").agg(F.max("is_query").alias("is_query"))
    return ids.join(asked, "vector").select(
        F.col("ids")[0].alias("rep"), "vector", "ids", "is_query"
    )


def _places(reps: DataFrame, curves: Curves) -> DataFrame:
    """``curve, kind, rep, place``: of vectors (kind 0) their rank along each curve, of queries
    (kind 1) the number of vectors before them; stored."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(0).to_numpy()
            vectors = _matrix(batch.column(1))
            asks = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            found = [(0, ids, curves.of_vectors(vectors))]
            if asks.any():
                found.append((1, ids[asks], curves.of_queries(vectors[asks])))
            for kind, own, keys in found:
                for curve, key in enumerate(keys):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(own), curve, np.int32)),
                            pa.array(key),
                            pa.array(np.full(len(own), kind, np.int32)),
                            pa.array(own),
                        ],
                        ["curve", "key", "kind", "rep"],
                    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            curve = batch.column(0).to_numpy()
            vector = (batch.column(2).to_numpy() == 0).astype(np.int64)
            place = np.empty(len(curve), np.int64)
            for c in np.unique(curve).tolist():
                own = curve == c
                before = np.cumsum(vector[own]) - vector[own] + seen.get(c, 0)
                place[own] = before
                seen[c] = int(before[-1] + vector[own][-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), batch.column(3),
                    pa.array(place), pa.array(np.full(len(curve), part, np.int32)),
                ],
                ["curve", "kind", "rep", "place", "part"],
            )

    keys = reps.select("rep", "vector", "is_query").mapInArrow(
        keyed, "curve int, key bigint, kind int, rep bigint"
    )
    order = ["curve", "key", "rep", "kind"]
    partitions = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = keys.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    inside = stage(
        sorted_.mapInArrow(counted, "curve int, kind int, rep bigint, place bigint, part int"),
        "places",
    )
    # One row per task and curve that meet.
    sizes = inside.groupBy("curve", "part").agg(F.sum(1 - F.col("kind")).alias("n"))
    earlier = Window.partitionBy("curve").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = sizes.select(
        "curve", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    return inside.join(bases, ["curve", "part"]).select(
        "curve", "kind", "rep", (F.col("place") + F.col("base")).alias("place")
    )


def _best(products: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the largest ``most`` of each row, and what is as good but for rounding."""
    if products.shape[1] > most:
        least = np.partition(products, -most, axis=1)[:, -most]
        return np.nonzero(products >= least[:, None] - _SLACK * np.maximum(1, np.abs(least))[:, None])
    return np.nonzero(np.ones_like(products, bool))


def compare(group: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    """``query, rep, score`` of the best candidates of a block for each query that reaches it."""
    group = group.combine_chunks()
    kind = group.column("kind").to_numpy()
    ids = group.column("rep").to_numpy()
    vectors = _matrix(group.column("vector").chunk(0))
    asking, there = kind == 1, kind == 0
    if not asking.any() or not there.any():
        return
    queries, rows = vectors[asking], vectors[there]
    query_ids, row_ids = ids[asking], ids[there]
    for begin in range(0, len(queries), 256):
        some = queries[begin : begin + 256]
        q, r = _best(some @ rows.T, most)
        score = np.zeros(len(q))
        for i in range(vectors.shape[1]):  # in one order, so equal vectors have equal scores
            score += some[q, i] * rows[r, i]
        order = np.lexsort((row_ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < most
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query_ids[begin:][q[top]]),
                pa.array(row_ids[r[top]]),
                pa.array(score[top]),
            ],
            ["query", "rep", "score"],
        )


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
    window_share: float = WINDOW_SHARE,
    curves: int = CURVES,
    dimensions: int = DIMENSIONS,
    bits: int = BITS,
    least_reach: int = LEAST_REACH,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each query, by inner product.

    Candidates of a query are all rows but those of its own id; ties go to the
    smaller id. Left out are rows with a NULL id and vectors that are NULL, empty,
    zero, hold a NULL or non-finite component, or have another length than most.
    Rows repeated in id and vector count once. Other columns are not read.
    """
    vector = F.col(vector_col)
    fine = rows.filter(F.col(id_col).isNotNull() & usable(vector)).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        vector.alias("vector"),
        is_query.alias("is_query"),
    )
    lengths = fine.groupBy(F.size("vector").alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), "size").first()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if usual is None:
        return rows.sparkSession.createDataFrame([], out)
    fine = stage(fine.filter(F.size("vector") == usual["size"]).distinct(), "vectors")
    reps = stage(distinct_vectors(fine, neighbours + 1), "distinct_vectors")
    square = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    count, longest = reps.agg(F.count("*"), F.sqrt(F.max(square))).first()
    line = Curves(usual["size"], longest, curves, dimensions, bits, seed)

    reach = max(least_reach, ceil(window_share * count / 2))
    block = max(256, min(reach // 2, 4_096))
    places = _places(reps, line)
    there = places.filter("kind = 0").withColumn("block", F.expr(f"place div {block}L"))
    lowest = F.greatest(F.col("place") - reach, F.lit(0))
    highest = F.least(F.col("place") + reach, F.lit(count - 1))
    asking = places.filter("kind = 1").withColumn(
        "block",
        F.explode(
            F.sequence(F.floor(lowest / F.lit(block)), F.floor(highest / F.lit(block)))
        ),
    )
    work = (
        there.unionByName(asking)
        .join(reps.select("rep", "vector"), "rep")
        .select("curve", "block", "kind", "rep", "vector")
    )
    found = by_group(
        work,
        ["curve", "block"],
        lambda group: compare(group, neighbours + 1),
        "query bigint, rep bigint, score double",
    )
    merged = found.groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = merged.withColumn("_place", F.row_number().over(best)).filter(
        F.col("_place") <= neighbours + 1
    )
    listed = top.join(reps.select("rep", "ids"), "rep").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    queries = (
        fine.filter("is_query")
        .join(reps.select("vector", F.col("rep").alias("query")), "vector")
        .select(F.col("vec_id").alias("query_id"), "query")
        .distinct()
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(listed, "query")
        .filter("vec_id != query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked).cast("int"))
        .filter(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
