"""Centroid clustering: Lloyd's rounds in exact integers, with Exponion's search for the nearest centroid.

A vector keeps an upper bound of the distance to its centroid and a lower bound of that to any other. Where they
cannot tell, only centroids inside a ball around the vector's centroid are compared, found in lists of centroids sorted
by their distance to each other. Vectors and bounds lie in a table between rounds and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.tables import drop, small_batches, stored
from lectern.llm.words import release

#: Integers of components end at these bounds, so that squared distances are longs.
MOST = 1 << 27
#: Dot products of integers below this are exact in doubles.
EXACT = 1 << 22
#: Relative and absolute room for rounding of distances, on the safe side.
ROOM, SLACK = 1e-9, 1e-6


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to the rows of c, integers."""
    if len(x) and len(c) and max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.empty((len(x), len(c)), np.int64)
    for j in range(len(c)):
        out[:, j] = ((x - c[j]) ** 2).sum(1)
    return out


def two_nearest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column of the least value of each row, the first of equal ones, that value, and the least of the other columns (as a float, infinite where there is none)."""
    rows = np.arange(len(d))
    near = d.argmin(1)
    least = d[rows, near]
    if d.shape[1] == 1:
        return near, least, np.full(len(d), np.inf)
    rest = d.astype(np.float64)
    rest[rows, near] = np.inf
    return near, least, rest.min(1)


class Search:
    """Nearest centroids of vectors whose bounds are known, for one set of centroids and their moves since the set before."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        self.c = centroids
        k = len(centroids)
        apart = np.sqrt(squared(centroids, centroids).astype(np.float64))
        self.order = np.argsort(apart, axis=1, kind="stable")  # its own place may follow an equal centroid's
        self.sorted = np.take_along_axis(apart, self.order, 1)
        self.next = self.sorted[:, 1] if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else np.sqrt(((centroids - before) ** 2).sum(1).astype(np.float64))
        self.moved = moved * (1 + ROOM)
        # the largest move of any other centroid
        self.others = np.array([max(np.delete(self.moved, j), default=0.0) for j in range(k)])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cluster, upper, lower) of vectors without bounds."""
        near, least, second = two_nearest(squared(x, self.c))
        return near, _up(least), _down(second)

    def again(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cluster, upper, lower) from those for the centroids before."""
        cluster, upper, lower = cluster.copy(), upper + self.moved[cluster], lower - self.others[cluster]
        bound = lambda at: np.maximum(lower[at], self.next[cluster[at]] / 2 * (1 - ROOM))
        at = np.flatnonzero(upper >= bound(slice(None)))
        if len(at):
            upper[at] = _up(((x[at] - self.c[cluster[at]]) ** 2).sum(1))
            at = at[upper[at] >= bound(at)]
        for a in np.unique(cluster[at]):
            mine = at[cluster[at] == a]
            # the nearest two centroids are at most so far from this one; equal distances are inside
            radius = (2 * upper[mine] + self.next[a]) * (1 + ROOM) + SLACK
            within = np.searchsorted(self.sorted[a], radius, "right")
            # lists of 2, 4, 8, ... centroids, the least that holds the ball
            size = np.minimum(1 << np.ceil(np.log2(np.maximum(within, 2))).astype(int), len(self.c))
            for n in np.unique(size):
                rows = mine[size == n]
                some = np.sort(self.order[a][:n])  # by number, so that the first of equal ones is the smallest
                near, least, second = two_nearest(squared(x[rows], self.c[some]))
                cluster[rows], upper[rows], lower[rows] = some[near], _up(least), _down(second)
        return cluster, upper, lower


def _up(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + ROOM)


def _down(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 - ROOM)


def integers(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors of ``dims`` finite components as integers floor(scale * x), ended at MOST."""
    v = F.col(f"`{vector_col}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * scale))).cast("int"))
    return vectors.where((F.size(v) == dims) & fine).select(F.col(f"`{id_col}`").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _assigned(centroids: np.ndarray, before: np.ndarray | None) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids, before)
        for batch in batches:
            x = _matrix(batch.column("v"), centroids.shape[1])
            if before is None:
                state = search.first(x)
            else:
                state = search.again(x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower")))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(state[0].astype(np.int32)), pa.array(state[1]), pa.array(state[2])], ["vec_id", "v", "cluster", "upper", "lower"])
        release()

    return step


def _sums(k: int, dims: int) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            np.add.at(sums, cluster, _matrix(batch.column("v"), dims))
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    return step


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids at the floor of the mean of their vectors; one without vectors stays. Each task sums its own vectors; the driver gets one number a component."""
    k, dims = centroids.shape
    parts = state.select("cluster", "v").mapInArrow(_sums(k, dims), "cluster int, n long, sums array<long>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(exact("part").alias("total"), exact("n").alias("n"))
    out = centroids.copy()
    for r in rows.collect():
        out[r.cluster, r["at"]] = int(r.total) // int(r.n)
    return out


def cluster(vectors: DataFrame, *, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the vectors with ``dims`` components, none null or not finite.

    Components are integers floor(scale * x), ended at -+2**27; distances are squared Euclidean ones of these, exact.
    Centroids start as the ``k`` vectors of the least sha256 of ``seed:id`` (equal ids: by components; a null id as the
    text ``null``), all vectors if there are fewer; a round assigns each vector to the nearest centroid, of equally
    near ones the smaller number, and moves each centroid that has vectors to the floor of their mean. After the last
    round vectors are assigned once more. Repeated rows count each. Other columns of the table, whatever their
    names, are not read. Without such vectors the result is empty.
    """
    small_batches(vectors.sparkSession)
    now = stored(integers(vectors, id_col, vector_col, dims, scale))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = now.orderBy(order, "v").select("v").limit(k).collect()
    centroids, before = np.array([r.v for r in first], np.int64).reshape(len(first), dims), None
    kind = f"vec_id {now.schema['vec_id'].dataType.simpleString()}, v array<int>, cluster int, upper double, lower double"
    for i in range(rounds + 1 if len(first) else 0):
        after = stored(now.mapInArrow(_assigned(centroids, before), kind))
        drop(now)
        now, before = after, centroids
        if i < rounds:
            centroids = moved(now, centroids)
    digest = [(j, [int(x) for x in c]) for j, c in enumerate(before if before is not None else [])]
    at = vectors.sparkSession.createDataFrame(digest, "cluster int, centroid array<long>")
    at = at.withColumn("centroid_sha256", F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256))
    if before is None:
        now = now.select("*", F.lit(None).cast("int").alias("cluster"))
    # k rows of centroids
    rows = now.select("vec_id", "v", "cluster").join(F.broadcast(at), "cluster")
    apart = F.aggregate(F.zip_with("v", "centroid", lambda x, c: (x - c) * (x - c)), F.lit(0).cast("long"), lambda s, x: s + x)
    rows = rows.select("vec_id", "cluster", apart.alias("distance"), "centroid_sha256")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    inertia = rows.groupBy("cluster").agg(exact("distance").alias("cluster_inertia"))
    # k rows
    whole = exact("cluster_inertia").over(Window.partitionBy(F.lit(0)))
    totals = inertia.select("cluster", F.col("cluster_inertia").cast("long").alias("cluster_inertia"), whole.cast("long").alias("inertia"))
    return rows.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
