"""Nearest neighbours by vantage-point trees, one tree per shard.

Vectors are dealt to shards by a hash of their id.  A shard's task builds a
tree of its vectors and answers all queries, which arrive as a stream behind
the vectors, so the task holds one shard and one batch of queries.  The nearest
of the shards' answers are the result.

Each inner node has a vantage point and the range of distances of its inner
and outer half.  A half is visited if its range, widened by the query's current
radius (distance of its k-th best) divided by ``factor``, holds the query's
distance to the vantage point.  ``factor=1`` is the triangle inequality: exact
search.  A larger factor visits fewer nodes and may miss neighbours.

Distances are Euclidean on the original components in double precision; ties
go to the smaller id.

Defined cases: vectors that are null, empty, zero, or that hold a null or
non-finite component take no part, neither as query nor as candidate; rows
without an id take no part; rows that repeat an id are candidates each, and
rows with a query's own id are no candidates of it; with fewer than ``k``
candidates all are returned; vectors of different length are not comparable:
a query meets only candidates of its own length; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score double"


class VPTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 128) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.leaf = ids[order], vectors[order], leaf
        self.computed = 0  # distances computed by searches
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # the member farthest from the first one: a point at the rim separates best
        point = self.vectors[rows[np.argmax(distances(self.vectors[rows[:1]], self.vectors[rows])[0])]]
        d = distances(point[None, :], self.vectors[rows])[0]
        if d.max() == d.min():  # all equally far (copies): nothing to split by
            return rows
        half = np.argsort(d, kind="stable")
        cut = len(rows) // 2
        inner, outer = half[:cut], half[cut:]
        return (
            point,
            (d[inner].min(), d[inner].max(), self._build(rows[np.sort(inner)])),
            (d[outer].min(), d[outer].max(), self._build(rows[np.sort(outer)])),
        )

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0):
        """(distances, ids) of each query's ``k`` nearest, nearest first; inf
        and -1 where there are fewer."""
        best = np.full((len(queries), k), np.inf)
        names = np.full((len(queries), k), -1, dtype=np.int64)
        self._visit(self.root, np.arange(len(queries)), query_ids, queries, best, names, factor)
        return best, names

    def _visit(self, node, active, query_ids, queries, best, names, factor) -> None:
        if not isinstance(node, tuple):
            self._leaf(node, active, query_ids, queries, best, names)
            return
        point, *halves = node
        d = distances(queries[active], point[None, :])[:, 0]
        gaps = [np.maximum(np.maximum(lo - d, d - hi), 0.0) for lo, hi, _ in halves]
        nearer = gaps[0] <= gaps[1]
        for first in (True, False):  # each query goes into its nearer half first
            for h, (_, _, child) in enumerate(halves):
                mine = nearer if (h == 0) == first else ~nearer
                # rounding can make a distance slightly too small for the inequality
                radius = best[active, -1] / factor * (1 + 1e-9) + 1e-12
                go = active[mine & (gaps[h] <= radius)]
                if len(go):
                    self._visit(child, go, query_ids, queries, best, names, factor)

    def _leaf(self, rows, active, query_ids, queries, best, names) -> None:
        k = best.shape[1]
        for at in range(0, len(rows), 1024):
            some = rows[at : at + 1024]
            for q in range(0, len(active), 256):
                who = active[q : q + 256]
                d = distances(queries[who], self.vectors[some])
                self.computed += d.size
                ids = np.broadcast_to(self.ids[some], d.shape)
                d = np.where(ids == query_ids[who][:, None], np.inf, d)
                all_d = np.concatenate([best[who], d], axis=1)
                all_i = np.concatenate([names[who], np.where(np.isinf(d), -1, ids)], axis=1)
                order = np.lexsort((np.where(all_i < 0, np.iinfo(np.int64).max, all_i), all_d), axis=1)[:, :k]
                best[who] = np.take_along_axis(all_d, order, axis=1)
                names[who] = np.take_along_axis(all_i, order, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all of ``b``; components are
    added in order, so equal vectors have equal distances everywhere."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        diff *= diff
        total += diff
    return np.sqrt(total)


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _search_shards(k: int, factor: float, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, parts, tree = None, [], [], None
        for batch in batches:
            keys, query = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            vec_ids = batch.column(2).to_numpy()
            flat = batch.column(3).flatten().to_numpy().astype(np.float64)
            lengths = np.diff(batch.column(3).offsets.to_numpy())
            starts = np.concatenate([[0], np.cumsum(lengths)])
            edges = [0, *(np.flatnonzero((np.diff(keys) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1), len(keys)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if keys[lo] != shard:
                    shard, ids, parts, tree = keys[lo], [], [], None
                rows = flat[starts[lo] : starts[hi]].reshape(hi - lo, -1)
                if not query[lo]:
                    ids.append(vec_ids[lo:hi])
                    parts.append(rows)
                    continue
                if not ids:
                    continue  # a shard without vectors
                if tree is None:
                    tree = VPTree(np.concatenate(ids), np.concatenate(parts), leaf)
                best, names = tree.search(vec_ids[lo:hi], rows, k, factor)
                found = names >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.broadcast_to(vec_ids[lo:hi, None], names.shape)[found]), pa.array(names[found]), pa.array(best[found])],
                    ["query_id", "vec_id", "score"],
                )

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.5, shard_rows: int = 8192,
            leaf: int = 128) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest vectors.

    Both tables: vec_id, embedding.  ``shard_rows`` bounds what one task holds
    (about that many vectors); with the data grow the shards, not their size.
    """

    def clean(df: DataFrame) -> DataFrame:
        vector = F.col("embedding").cast("array<double>")
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding")).filter(
            F.col("vec_id").isNotNull() & usable(F.col("embedding"))
        )

    data, asked = clean(vectors), clean(queries)
    # a shard holds vectors of one length
    dims = {r["dim"]: r["n"] for r in data.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).collect()}
    if not dims:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first, shards = {}, 0
    for dim, n in sorted(dims.items()):
        first[dim] = (shards, math.ceil(n / shard_rows))
        shards += first[dim][1]
    start = F.create_map(*[x for d, (s, _) in first.items() for x in (F.lit(d), F.lit(s).cast("long"))])
    count = F.create_map(*[x for d, (_, c) in first.items() for x in (F.lit(d), F.lit(c).cast("long"))])
    dim = F.size("embedding")
    dealt = data.select(
        (start[dim] + F.pmod(F.xxhash64("vec_id"), count[dim])).alias("shard"),
        F.lit(False).alias("is_query"), "vec_id", "embedding",
    )
    spread = asked.filter(count[dim].isNotNull()).select(
        F.explode(F.sequence(start[dim], start[dim] + count[dim] - 1)).alias("shard"),
        F.lit(True).alias("is_query"), "vec_id", "embedding",
    )
    laid_out = dealt.unionByName(spread).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "is_query")
    found = laid_out.mapInArrow(_search_shards(k, factor, leaf), FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
