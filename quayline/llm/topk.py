"""Exact maximum inner product search: ball trees per shard, branch and bound.

Vectors are dealt into shards of about ``SHARD`` rows. A shard's rows are put
into a ball tree whose nodes hold centre, radius and smallest id. A block of
queries, the queries that live in one shard, walks a tree from the node with
the higher upper bound (query x centre + |query| x radius) and leaves out the
nodes whose bound cannot beat the query's k-th score. Every block first searches
its own shard; the k-th scores found there then bound the search of all other
shards.

Components x count as floor(scale * x), scores are whole numbers. Vectors that
are null, or hold a null or non-finite component, and rows with a null id take
no part. Rows that share an id count once, with their smallest vector. Shorter
vectors are filled up with zeros. Fewer candidates than k: all of them. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.session import configure, staged

SHARD = 8_192
LEAF = 128
SCALE = 64
K = 20
NONE = np.iinfo(np.int64).min
EXACT = float(1 << 53)


class BallTree:
    """Nodes in arrays; rows of a node are contiguous."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []  # first row, last row, left child, right child
        stack = [(0, len(ids), -1, 0)]
        while stack:
            lo, hi, parent, side = stack.pop()
            me = len(self.nodes)
            self.nodes.append((lo, hi, -1, -1))
            if parent >= 0:
                n = list(self.nodes[parent])
                n[2 + side] = me
                self.nodes[parent] = tuple(n)
            if hi - lo > leaf:
                part = order[lo:hi]
                spread = np.ptp(vectors[part], axis=0)
                column = vectors[part, int(spread.argmax())] if len(spread) else np.zeros(hi - lo)
                half = (hi - lo) // 2
                order[lo:hi] = part[np.argpartition(column, half)]
                stack += [(lo + half, hi, me, 1), (lo, lo + half, me, 0)]
        self.ids, self.rows = ids[order], vectors[order]
        self.centres = np.stack([self.rows[a:b].mean(axis=0) for a, b, _, _ in self.nodes])
        self.radii = np.array(
            [np.sqrt(((self.rows[a:b] - c) ** 2).sum(axis=1).max()) for (a, b, _, _), c in zip(self.nodes, self.centres)]
        )
        self.least = np.array([self.ids[a:b].min() for a, b, _, _ in self.nodes])

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int, score: np.ndarray, ids: np.ndarray) -> None:
        """Improve each query's best ``k`` (score, id) pairs in place, best first, ties to the smaller id."""
        size = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        # A little above the true bound, so that rounding never cuts off a hit.
        bound = (q @ self.centres.T + size[:, None] * self.radii) * (1 + 1e-9) + 1e-6
        bound += 2e-9 * size[:, None] * np.sqrt((self.centres**2).sum(axis=1))

        def open_rows(node: int, rows: np.ndarray) -> np.ndarray:
            b, worst = bound[rows, node], score[rows, -1]
            top = np.floor(b)
            return rows[(top > worst) | (top == worst) & (self.least[node] < ids[rows, -1])]

        stack = [(0, np.arange(len(q)))]
        while stack:
            node, rows = stack.pop()
            rows = open_rows(node, rows)
            if not len(rows):
                continue
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                pair = (left, right) if bound[rows, left].sum() < bound[rows, right].sum() else (right, left)
                stack += [(pair[0], rows), (pair[1], rows)]
                continue
            got = np.rint(q[rows] @ self.rows[lo:hi].T).astype(np.int64)
            named = np.broadcast_to(self.ids[lo:hi], got.shape)
            got = np.where(named == q_ids[rows, None], NONE, got)
            worst = score[rows, -1:]
            better = ((got > worst) | (got == worst) & (named < ids[rows, -1:])).any(axis=1)
            rows, got, named = rows[better], got[better], named[better]
            if not len(rows):
                continue
            all_s = np.concatenate((score[rows], got), axis=1)
            all_i = np.concatenate((ids[rows], named), axis=1)
            best = np.lexsort((all_i, -all_s.astype(np.float64)), axis=1)[:, :k]
            score[rows], ids[rows] = np.take_along_axis(all_s, best, 1), np.take_along_axis(all_i, best, 1)


def _matrix(values: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = values.to_pylist()
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width))
    for i, row in enumerate(lists):
        out[i, : len(row)] = row
    return out


def _fill(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _shards(group: pa.Table) -> pa.Table:
    """A shard's rows as one row of packed bytes."""
    ids = np.asarray(group.column("vec_id"), dtype=np.int64)
    m = _matrix(group.column("vector"))
    n = [[group.column("shard")[0].as_py()], [len(ids)], [m.shape[1]], [ids.tobytes()], [m.tobytes()]]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(v, t) for v, t in zip(n, kinds)], names=["shard", "n", "width", "ids", "vectors"])


_PACKED = "shard int, n int, width int, ids binary, vectors binary"
_TOP = "query_id bigint, vec_id bigint, score bigint"


def _unpack(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[prefix + "ids"], dtype=np.int64)
    return ids, np.frombuffer(row[prefix + "vectors"], dtype=np.float64).reshape(len(ids), row[prefix + "width"])


def _search(k: int, leaf: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, vectors = _unpack(row)
                q_ids, q = _unpack(row, "q_")
                own = q_ids % every == 0
                q_ids, q = q_ids[own], q[own]
                width = max(vectors.shape[1], q.shape[1])
                vectors, q = _fill(vectors, width), _fill(q, width)
                if not len(q_ids) or not len(ids):
                    continue
                score = np.full((len(q_ids), k), NONE, dtype=np.int64)
                best = np.full((len(q_ids), k), np.iinfo(np.int64).max, dtype=np.int64)
                if row["kth"]:
                    known = {r["query_id"]: (r["score"], r["vec_id"]) for r in row["kth"]}
                    for j, name in enumerate(q_ids.tolist()):
                        if name in known:
                            score[j, -1], best[j, -1] = known[name]
                bounds = score[:, -1].copy(), best[:, -1].copy()
                if width and np.abs(q).max() * np.abs(vectors).max() * width >= EXACT:
                    raise ValueError("components are too large for exact scores")
                BallTree(ids, vectors, leaf).search(q_ids, q, k, score, best)
                found = score > NONE
                # The bound itself belongs to another shard.
                found &= ~((score == bounds[0][:, None]) & (best == bounds[1][:, None]))
                at = np.nonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at[0]]), pa.array(best[at]), pa.array(score[at])], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(
    vectors: DataFrame, k: int = K, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shard_rows: int = SHARD, leaf: int = LEAF
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each id divisible by ``every`` the k best other rows."""
    spark = configure(vectors.sparkSession)
    v = F.col(vector).cast("array<double>")
    usable = vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & F.forall(v, _finite))
    whole = F.transform(v, lambda x: F.floor(x * float(scale)).cast("double"))
    rows = usable.select(F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("vector"))
    rows = staged(spark, rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    packed = staged(spark, dealt.groupBy("shard").applyInArrow(_shards, _PACKED), "shards")
    queries = dealt.where(F.col("vec_id") % every == 0).groupBy("shard").applyInArrow(_shards, _PACKED)
    queries = staged(spark, queries.select(F.col("shard").alias("block"), *[F.col(c).alias("q_" + c) for c in ("width", "ids", "vectors")]), "queries")
    search = _search(k, leaf, every)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    none = F.lit(None).cast("array<struct<query_id:bigint,score:bigint,vec_id:bigint>>")
    # First round: every block in its own shard. One task a pair, as each is work for seconds.
    home = packed.join(queries, F.col("shard") == F.col("block")).withColumn("kth", none)
    first = staged(spark, home.repartitionByRange(shards, "shard").mapInArrow(search, _TOP), "first")
    if shards > 1:
        ranked = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
        block = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int").alias("block")
        kth = ranked.groupBy(block).agg(F.collect_list(F.struct("query_id", "score", "vec_id")).alias("kth"))
        bounded = queries.join(kth, "block", "left")
        # All other pairs of shard and block, each block and shard a few megabytes.
        pairs = spark.range(shards * shards).select(
            (F.col("id") / shards).cast("int").alias("shard"), (F.col("id") % shards).cast("int").alias("block")
        ).where("shard <> block")
        work = pairs.join(packed, "shard").join(bounded, "block").withColumn("pair", F.col("shard").cast("bigint") * shards + F.col("block"))
        rest = work.repartitionByRange(min(shards * shards, 4 * max(shards, spark.sparkContext.defaultParallelism)), "pair").mapInArrow(search, _TOP)
        first = first.unionByName(rest)
    ranked = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
