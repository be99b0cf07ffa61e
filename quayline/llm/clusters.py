"""Exact k-means in integers by shallot search.

A vector's state is its two nearest centroids as last seen, an upper bound on the distance
to the first and a lower bound on the distance to all others. A round first moves the bounds
by how far the centroids have moved; a vector whose upper bound stays below the lower one
keeps its cluster unlooked. For the others both remembered centroids are measured, the search
starts at the closer one and goes through that one's neighbours, nearest first. By the triangle
inequality only neighbours within the distance to the start plus the distance to the second
best so far can change the outcome, a ball that shrinks with every better centroid found.

Bounds are rounded outwards and comparisons strict, so they only save work. What decides are
squared distances in 64-bit integers, ties going to the smaller number. Centroids are k rows of
known width and travel with the tasks; vectors and states lie in the shared folder, one table
a round, which replaces that of the round before. Sums are built per cluster inside the tasks
first, so a cluster of any share of the rows is k rows a task.

Components x count as floor(scale * x). Vectors that are null, of another width or hold a null
or non-finite component take no part. Each remaining row counts, also where ids are null or repeat;
first centroids are the rows with the smallest hashes, among equal ids those with the smaller
vector first, and a null id hashes as no digits. With fewer rows than k there are as many centroids
as rows, an empty table gives an empty result, extra columns are ignored. Components beyond
2^24 after scaling would leave exact sums and raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.session import configure, scratch_path
from quayline.sources import filesystem

K, ROUNDS, WIDTH, SCALE, SEED = 40, 5, 64, 256, 2
#: Largest component: squared distances and their bounds then fit 64-bit integers at any width up to 2^12.
LARGEST = 1 << 24
# Relative room for rounding in square roots and sums of bounds.
ROOM = 1e-9

_STATE = "vec_id bigint, vector binary, first int, second int, upper double, lower double, distance bigint"


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid, or to one each."""
    apart = vectors - centroids
    return np.einsum("ij,ij->i", apart, apart)


class Centroids:
    """Centroids, for each the others in order of distance, and how far each has moved."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None):
        self.now, self.k = now, len(now)
        apart = np.stack([distances(now, c) for c in now]) if self.k else np.zeros((0, 0), dtype=np.int64)
        order = np.argsort(apart, axis=1, kind="stable")
        #: Neighbours without the centroid itself, which is not first where centroids are equal.
        self.near = np.stack([o[o != c] for c, o in enumerate(order)]) if self.k else order
        self.gap = np.sqrt(np.take_along_axis(apart, self.near, 1).astype(np.float64)) * (1 - ROOM)
        moved = np.zeros(self.k) if before is None else np.array([np.sqrt(float(distances(a[None], b)[0])) for a, b in zip(now, before)])
        self.moved = moved * (1 + ROOM)
        # For the lower bound: the largest move of any centroid but one's own.
        self.farthest = np.array([np.delete(self.moved, c).max(initial=0.0) for c in range(self.k)])


def _better(d: np.ndarray, c, e: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where centroid ``c`` at ``d`` comes before ``b`` at ``e``."""
    return (d < e) | ((d == e) & (c < b))


def assign(vectors: np.ndarray, state: dict[str, np.ndarray], centroids: Centroids) -> int:
    """Bring ``state`` up to the centroids; returns how many distances it took."""
    k = centroids.k
    first, second, upper, lower, distance = (state[n] for n in ("first", "second", "upper", "lower", "distance"))
    upper += centroids.moved[first]
    lower -= centroids.farthest[first]
    lower *= np.where(lower > 0, 1 - ROOM, 1 + ROOM)
    upper *= 1 + ROOM
    # The distance to one's own centroid has changed where that has moved, and is part of the result.
    stale = (centroids.moved[first] > 0) | (distance < 0)
    sure = upper < lower
    again = np.flatnonzero(sure & stale)
    if len(again):
        distance[again] = distances(vectors[again], centroids.now[first[again]])
        upper[again] = np.sqrt(distance[again].astype(np.float64)) * (1 + ROOM)
    open_ = np.flatnonzero(~sure)
    taken = len(again) + len(open_)
    da = distances(vectors[open_], centroids.now[first[open_]])
    distance[open_], upper[open_] = da, np.sqrt(da.astype(np.float64)) * (1 + ROOM)
    if k == 1:
        lower[open_] = np.inf
        return taken
    # The bound on one's own centroid is tight now; the others have to be searched only if it still is not enough.
    doubt = upper[open_] >= lower[open_]
    open_, da = open_[doubt], da[doubt]
    a, b, x = first[open_].copy(), second[open_].copy(), vectors[open_]
    db = distances(x, centroids.now[b])
    taken += len(open_)
    turn = _better(db, b, da, a)
    a, b, da, db = np.where(turn, b, a), np.where(turn, a, b), np.where(turn, db, da), np.where(turn, da, db)
    start, near = a.copy(), np.sqrt(da.astype(np.float64)) * (1 + ROOM)
    for s in np.unique(start):
        rows = np.flatnonzero(start == s)
        for c, gap in zip(centroids.near[s], centroids.gap[s]):
            # Who is farther from the start than this is farther from the vector than its second best.
            rows = rows[gap <= near[rows] + np.sqrt(db[rows].astype(np.float64)) * (1 + ROOM)]
            if not len(rows):
                break
            some = rows[b[rows] != c] if np.any(b[rows] == c) else rows
            d = distances(x[some], centroids.now[c])
            taken += len(some)
            best = _better(d, c, da[some], a[some])
            next_ = ~best & _better(d, c, db[some], b[some])
            at = some[best]
            a[at], b[at], da[at], db[at] = c, a[at], d[best], da[at]
            at = some[next_]
            b[at], db[at] = c, d[next_]
    first[open_], second[open_], distance[open_] = a, b, da
    upper[open_] = np.sqrt(da.astype(np.float64)) * (1 + ROOM)
    lower[open_] = np.sqrt(db.astype(np.float64)) * (1 - ROOM)
    return taken


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, width).astype(np.int64)


def _assigner(centroids: Centroids, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column("vector"), width)
            state = {n: batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ("first", "second", "upper", "lower", "distance")}
            assign(x, state, centroids)
            columns = [batch.column("vec_id"), batch.column("vector"), *(pa.array(v) for v in state.values())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", *state])

    return run


def _summer(k: int, width: int):
    """A task's rows per cluster: number, vector sum, distance sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            first = batch.column("first").to_numpy()
            x = _vectors(batch.column("vector"), width)
            counts += np.bincount(first, minlength=k)
            for c in np.unique(first):
                sums[c] += x[first == c].sum(axis=0)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    return run


def _packer(k: int, width: int):
    """Whole vectors as 32-bit integers, with a state that bounds nothing yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = np.asarray(batch.column("vector").flatten(), dtype=np.float64).reshape(n, width)
            if np.abs(x).max(initial=0) > LARGEST:
                raise ValueError("components are too large for exact distances")
            packed = [row.tobytes() for row in x.astype("<i4")]
            state = [np.zeros(n, dtype=np.int32), np.full(n, min(1, k - 1), dtype=np.int32), np.full(n, np.inf), np.zeros(n), np.full(n, -1)]
            columns = [batch.column("vec_id"), pa.array(packed, pa.binary()), *map(pa.array, state)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "first", "second", "upper", "lower", "distance"])

    return run


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def _first_centroids(rows: DataFrame, k: int, seed: int, width: int) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    # The order among copies of an id is that of the vectors' components.
    whole = rows.select(key.alias("key"), "ints").orderBy("key", "ints").limit(k)
    return np.array([r["ints"] for r in whole.collect()], dtype=np.int64).reshape(-1, width)


class Clustering:
    """The final assignment and centroids."""

    def __init__(self, rows: DataFrame, centroids: np.ndarray):
        self.rows, self.centroids = rows, centroids

    def summary(self) -> DataFrame:
        """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for every vector."""
        rows, spark = self.rows, self.rows.sparkSession
        per = {r["cluster"]: r["inertia"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
        total = sum(per.values())
        digests = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in self.centroids]
        # A row a cluster, at most k of them.
        table = [(c, inertia, total, digests[c]) for c, inertia in per.items()]
        named = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
        named = rows.join(F.broadcast(named), "cluster")
        return named.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, vec_id: str = "vec_id", vector: str = "embedding", width: int = WIDTH, scale: int = SCALE, seed: int = SEED
) -> Clustering:
    """k-means of the integer vectors: ``rounds`` rounds of assignment and update, then a last assignment."""
    if k < 1 or rounds < 0 or not 1 <= width <= 1 << 12:
        raise ValueError("k and the width have to be positive, the width at most 4096, and rounds not negative")
    spark = configure(vectors.sparkSession)
    v = F.col(vector).cast("array<double>")
    usable = vectors.where(v.isNotNull() & (F.size(v) == width) & F.forall(v, finite))
    whole = F.transform(v, lambda x: F.floor(x * float(scale)).cast("double"))
    rows = usable.select(F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("vector"))
    start = _first_centroids(rows.withColumn("ints", F.col("vector").cast("array<bigint>")), k, seed, width)
    if not len(start):
        return Clustering(spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), start)
    state = rows.mapInArrow(_packer(len(start), width), _STATE)
    before, now, old = None, start, None
    for last in [False] * rounds + [True]:
        path = scratch_path(spark, "clusters")
        state.mapInArrow(_assigner(Centroids(now, before), width), _STATE).write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if old:
            # The round just written depends on nothing but itself.
            filesystem.delete(spark, old)
        old = path
        if not last:
            parts = state.select("first", "vector").mapInArrow(_summer(len(now), width), "cluster int, n bigint, sums array<bigint>")
            total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
            before, now = now, now.copy()
            for r in total.collect():
                now[r["cluster"]] = np.array(r["sums"], dtype=np.int64) // r["n"]
    return Clustering(state.select("vec_id", F.col("first").alias("cluster"), "distance"), now)
