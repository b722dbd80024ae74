"""Nearest neighbours by stable projections, kd-trees and a chi-square stopping test.

Largest inner products become smallest distances: a vector x of a table with largest norm M gets
one more component sqrt(M^2 - |x|^2), a query gets 0; then the squared distance is
M^2 + |q|^2 - 2 (q . x).

Index. Vectors are dealt to blocks of about ``BLOCK_ROWS``; a block is one row with its
vectors projected to ``PROJECTED`` dimensions by Gaussian directions and ordered as a balanced
kd-tree, whose leaves have bounding boxes. Equal vectors of a block are one point with
the ``k`` smallest ids.

Search. Queries, also in blocks, meet every index block. A query takes the leaves by
their distance in the projection and computes true inner products of their points that are
near enough in the projection. For a point at true distance d the squared projected distance over d^2 is chi-square with
``PROJECTED`` degrees of freedom. So the search of a query stops when the next leaf is so
far away that a point nearer than the k-th found would lie there with a probability below
``MISS``. The blocks' best are ranked once more per query.

Defined cases: vectors that are NULL, all zero, hold NULL or non-finite components, or have
another length than most of the table take no part; NULL ids take no part; rows
that repeat an id are candidates of other ids each on its own, never of their own id; with
fewer candidates all are returned; ties go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronscope.llm.common import parts, stored

PROJECTED = 8
BLOCK_ROWS = 16_384
LEAST_ROWS = 1_024
QUERY_ROWS = 1_024
LEAF = 64
MISS = 0.02

PACKED = pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
PACKED_DDL = "block int, ids binary, vectors binary"
FOUND_DDL = "query_id long, vec_id long, score double"
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def chi_square_cdf(x: float, degrees: int) -> float:
    """The distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi_square_bound(p: float, degrees: int) -> float:
    """The x at which the distribution function is ``p``."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


def directions(dimensions: int) -> np.ndarray:
    """The Gaussian directions; the same in every task."""
    return np.random.default_rng(11).standard_normal((dimensions, PROJECTED))


def kd_order(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which each ``LEAF`` neighbours are a leaf, and the leaves' ends.

    Each step halves a range at the median of its widest dimension.
    """
    order, ends = np.arange(len(points)), []
    todo = [(0, len(points))]
    while todo:
        a, b = todo.pop()
        if b - a <= LEAF:
            ends.append(b)
            continue
        own = points[order[a:b]]
        widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(own[:, widest], middle)]
        todo += [(a + middle, b), (a, a + middle)]
    return order, np.array(sorted(ends), np.int64)


class Block:
    """The kd-tree over one block's distinct vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, k: int) -> None:
        by_id = np.argsort(ids, kind="stable")
        ids, vectors = ids[by_id], vectors[by_id]
        rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1])))
        _, first, owner = np.unique(rows.ravel(), return_index=True, return_inverse=True)
        distinct = vectors[first]
        extra = np.sqrt(np.maximum(norm**2 - (distinct**2).sum(axis=1), 0))
        points = np.column_stack([distinct, extra]) @ directions(distinct.shape[1] + 1)
        order, ends = kd_order(points)
        starts = np.concatenate(([0], ends[:-1]))
        self.vectors, points = distinct[order], points[order]
        self.projected = points
        self.spans = list(zip(starts.tolist(), ends.tolist()))
        self.low = np.minimum.reduceat(points, starts, axis=0)
        self.high = np.maximum.reduceat(points, starts, axis=0)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # ids by point, ascending within one; a query's own id may be among them
        by_point = np.argsort(place[owner], kind="stable")
        self.ids = ids[by_point]
        self.cuts = np.searchsorted(place[owner][by_point], np.arange(len(order) + 1))
        self.k, self.norm = k, norm

    def search(self, query_id: int, query: np.ndarray, bound: float) -> tuple[list[tuple[float, int]], int]:
        """The best ``(score, id)`` found, and how many points were verified."""
        projected = np.append(query, 0.0) @ directions(len(query) + 1)
        gap = np.maximum(np.maximum(self.low - projected, projected - self.high), 0)
        distance = (gap**2).sum(axis=1)
        visits = np.argsort(distance, kind="stable")
        base = self.norm**2 + float(query @ query)
        scores = np.empty(0)
        points = np.empty(0, np.int64)
        kth, at, step, verified = -np.inf, 0, 4, 0
        while at < len(visits):
            # what is left lies at least this far away in the projection
            farthest = max(base - 2 * kth, 0.0) if kth > -np.inf else np.inf
            if distance[visits[at]] > bound * farthest:
                break
            chosen = [np.arange(*self.spans[i]) for i in visits[at : at + step]]
            at, step = at + step, step * 2
            new = np.concatenate(chosen)
            if kth > -np.inf:  # the same test for each point of these leaves
                new = new[((self.projected[new] - projected) ** 2).sum(axis=1) <= bound * farthest]
            verified += len(new)
            scores = np.concatenate([scores, exact(self.vectors[new], query)])
            points = np.concatenate([points, new])
            # k + 1 points hold k other ids at least; all ties with the last stay
            if len(scores) > self.k + 1:
                kth = np.partition(scores, -(self.k + 1))[-(self.k + 1)]
                points, scores = points[scores >= kth], scores[scores >= kth]
        found = []
        for score, p in zip(scores.tolist(), points.tolist()):
            own = self.ids[self.cuts[p] : self.cuts[p + 1]]
            found += [(-score, i) for i in own[own != query_id][: self.k].tolist()]
        return sorted(found)[: self.k], verified


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order."""
    return np.einsum("ij,j->i", vectors, query)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, as doubles."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where("vec_id is not null and vector is not null and size(vector) > 0")
    infinite = float("inf")

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == infinite)

    rows = rows.where(~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (common.n if common else 0))


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """Blocks of ids and vectors, dealt by a hash of the id and the vector."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        data = table.column("vector").combine_chunks().flatten().to_numpy()
        return pa.table([table.column("block").slice(0, 1), [ids.tobytes()], [data.tobytes()]], schema=PACKED)

    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
    return rows.withColumn("block", block).groupBy("block").applyInArrow(pack, PACKED_DDL)


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20, miss: float = MISS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows that ``is_query`` chooses by ``vec_id``."""
    rows = stored(usable(embeddings), "vectors")
    squared = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, n_queries, longest = rows.agg(
        F.count("*"), F.count(F.when(is_query, 1)), F.max(squared)
    ).first()
    # small tables still give every task a block
    blocks = max(-(-n // BLOCK_ROWS), min(parts(rows), -(-n // LEAST_ROWS)), 1)
    query_blocks = max(1, -(-n_queries // QUERY_ROWS))
    norm, bound = math.sqrt(longest or 0.0), chi_square_bound(1 - miss, PROJECTED)
    index = packed(rows, blocks)
    asked = packed(rows.where(is_query), query_blocks).select(
        F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = None, None
        for b in batches:
            for i in range(b.num_rows):
                number = b.column("block")[i].as_py()
                if number != known:
                    ids = np.frombuffer(b.column("ids")[i].as_py(), np.int64)
                    vectors = np.frombuffer(b.column("vectors")[i].as_py()).reshape(len(ids), -1)
                    known, block = number, Block(ids, vectors, norm, k)
                own = np.frombuffer(b.column("query_ids")[i].as_py(), np.int64)
                queries = np.frombuffer(b.column("queries")[i].as_py()).reshape(len(own), -1)
                out: list[tuple] = []
                for query_id, query in zip(own.tolist(), queries):
                    best, _ = block.search(query_id, query, bound)
                    out += [(query_id, vec_id, -score) for score, vec_id in best]
                columns = list(zip(*out)) or [[], [], []]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, FOUND)]
                yield pa.RecordBatch.from_arrays(arrays, schema=FOUND)

    pairs = index.join(asked, "block").select("block", "ids", "vectors", "query_ids", "queries")
    found = pairs.mapInArrow(search, FOUND_DDL)
    first = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
