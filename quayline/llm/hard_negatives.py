"""Hard negatives of anchors, with scores bounded along spanning trees of the anchors.

Anchors are sorted by label and by the signs of a few fixed projections, so that near ones fall
into one block, and each block of at most ``BLOCK`` anchors has its minimum spanning tree. Rows
lie in shards of about ``SHARD``; every pair of block and shard is one step of work. In it the
scores of the shard's rows with the tree's root are computed. From a parent's bounds follow a
child's: they differ by the edge's length times the row's norm at most. Rows whose bounds do not
overlap what is asked for keep just the bounds, the others are scored again, in integers.

What is asked for, first: the best rows of an anchor's label. A row whose upper bound lies below
the shard's kth largest lower bound is left alone. Then, with the scores of those positives known:
the rows of other labels whose bounds overlap one of the windows
``low * positive <= 100 * score <= high * positive``. Both steps reduce to the best few rows of an
anchor within a step of work, and over all shards by one ranking. Shards stay where they are, once
dealt out; blocks are sent to all of them, as every anchor asks for all rows.

Components count as floor(scale * x), scores are whole numbers, ties go to the smaller id. Rows
with a null id, label or vector, or with a null or non-finite component, take no part. Rows that
share an id count once, with the smallest label and vector. Shorter vectors are filled up with
zeros. Fewer rows than asked for: all of them. An empty table, or one without anchors or without
positives, gives an empty result; extra columns are ignored. Scores beyond 2^53 or components beyond 2^31 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.llm.clusters import finite
from quayline.session import configure, staged

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LOW, HIGH = 50, 95
SCALE = 256
#: Anchors in a block, rows in a shard, and signs that order the anchors.
BLOCK, SHARD, SIGNS = 256, 8_192, 16
#: Shards are not made smaller than this for the sake of more tasks.
LEAST = 512
EXACT = float(1 << 53)
ROOM = 1e-9

_ROWS = "part int, ids array<bigint>, labels array<bigint>, vectors binary"
_FOUND = "anchor_id bigint, vec_id bigint, score bigint"
_MINED = "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent and edge length of a minimum spanning tree that starts at the first point; parents come first."""
    n = len(points)
    order, parent, edge = [0], np.full(n, -1), np.zeros(n)
    inside = np.zeros(n, dtype=bool)
    inside[0] = True
    best = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    link = np.zeros(n, dtype=np.int64)
    for _ in range(n - 1):
        at = int(np.where(inside, np.inf, best).argmin())
        inside[at] = True
        order.append(at)
        parent[at], edge[at] = link[at], best[at]
        far = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        nearer = far < best
        best, link = np.where(nearer, far, best), np.where(nearer, at, link)
    return np.array(order), parent, edge


class Block:
    """A block's anchors with their tree."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order, self.parent, self.edge = spanning_tree(vectors)
        self.children = np.bincount(self.parent[self.parent >= 0], minlength=len(ids))


class Shard:
    """A shard's rows and their norms; counts the scores that are computed."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.norms = np.sqrt((vectors**2).sum(axis=1)) * (1 + ROOM)
        self.scored = 0

    def scores(self, vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of rows; all are taken where that is cheaper than picking."""
        self.scored += len(rows)
        if 2 * len(rows) > len(self.ids):
            return (self.vectors @ vector)[rows]
        return self.vectors[rows] @ vector

    def walk(self, block: Block, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(anchor, rows, scores)`` of the rows that ``wanted(anchor, low, high)`` picks by their bounds."""
        if len(self.ids) and len(block.ids):
            top = max(np.abs(self.vectors).max(initial=0), np.abs(block.vectors).max(initial=0))
            if top * top * max(1, self.vectors.shape[1]) >= EXACT:
                raise ValueError("components are too large for exact scores")
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        open_ = block.children.copy()
        everything = np.arange(len(self.ids))
        for a in block.order.tolist():
            p = int(block.parent[a])
            if p < 0:
                exact = self.scores(block.vectors[a], everything)
                low, high = exact.copy(), exact.copy()
                rows = wanted(a, low, high)
                yield a, rows, exact[rows]
            else:
                room = self.norms * (block.edge[a] * (1 + ROOM)) + 1.0
                low, high = bounds[p][0] - room, bounds[p][1] + room
                rows = wanted(a, low, high)
                exact = self.scores(block.vectors[a], rows)
                low[rows] = high[rows] = exact
                yield a, rows, exact
                open_[p] -= 1
                if not open_[p]:
                    del bounds[p]
            if open_[a]:
                bounds[a] = low, high


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, then smaller ids."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def positives(block: Block, shard: Shard, k: int) -> Iterator[tuple[int, int, int]]:
    """``(anchor, row, score)`` of the shard's k best rows of each anchor's label."""
    same = {label: np.flatnonzero(shard.labels == label) for label in np.unique(block.labels).tolist()}

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        rows = same[int(block.labels[a])]
        rows = rows[shard.ids[rows] != block.ids[a]]
        if len(rows) <= k:
            return rows
        return rows[high[rows] >= np.partition(low[rows], len(rows) - k)[len(rows) - k]]

    for a, rows, score in shard.walk(block, wanted):
        best = _best(score, shard.ids[rows], k)
        yield from zip([int(block.ids[a])] * len(best), shard.ids[rows[best]].tolist(), np.rint(score[best]).astype(np.int64).tolist())


def _joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Windows with those that touch made one."""
    out: list[tuple[int, int]] = []
    for from_, to in sorted(windows):
        if out and from_ <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], to))
        else:
            out.append((from_, to))
    return out


def negatives(
    block: Block, shard: Shard, known: dict[int, list[tuple[int, int]]], k: int, low_share: int, high_share: int
) -> Iterator[tuple[int, int, int, int, int]]:
    """``(anchor, positive, negative, positive score, score)``: the k best rows of other labels in each window."""
    # Whole scores within a share of the positive's: from the ceiling of the one to the floor of the other.
    windows = {a: [(i, s, -(-low_share * s // 100), high_share * s // 100) for i, s in known.get(int(n), [])] for a, n in enumerate(block.ids)}
    windows = {a: [w for w in ws if w[2] <= w[3]] for a, ws in windows.items()}
    other = {label: np.flatnonzero(shard.labels != label) for label in np.unique(block.labels).tolist()}

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        rows = other[int(block.labels[a])]
        inside = np.zeros(len(rows), dtype=bool)
        for from_, to in _joined([w[2:] for w in windows[a]]):
            inside |= (high[rows] >= from_) & (low[rows] <= to)
        return rows[inside]

    for a, rows, score in shard.walk(block, wanted):
        for positive, s, from_, to in windows[a]:
            fit = np.flatnonzero((score >= from_) & (score <= to))
            best = fit[_best(score[fit], shard.ids[rows[fit]], k)]
            for row, found in zip(shard.ids[rows[best]].tolist(), np.rint(score[best]).astype(np.int64).tolist()):
                yield int(block.ids[a]), positive, row, s, found


def _packed(part: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, labels, vectors = ([r[i] for r in rows] for i in range(3))
    whole = np.array(vectors, dtype=np.float64)
    if np.abs(whole).max(initial=0) >= 1 << 31:
        raise ValueError("components are too large for exact scores")
    values = [[part], [ids], [labels], [whole.astype("<i4").tobytes()]]
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["part", "ids", "labels", "vectors"])


def _packer(size: int):
    """Rows that come sorted by ``part`` as packed rows of at most ``size`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("part", "vec_id", "label", "vector")))

        for part, group in groupby(rows(), key=lambda r: r[0]):
            held: list[tuple] = []
            for _, *row in group:
                held.append(row)
                if len(held) == size:
                    yield _packed(part, held)
                    held = []
            if held:
                yield _packed(part, held)

    return run


def _unpack(row: pa.RecordBatch, width: int, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (row.column(prefix + c)[0].values.to_numpy() for c in ("ids", "labels"))
    packed = np.frombuffer(row.column(prefix + "vectors")[0].as_py(), dtype="<i4")
    return ids, labels, packed.reshape(len(ids), width).astype(np.float64)


def _pairs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[Block, Shard, pa.RecordBatch]]:
    piece, shard = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            if (at := row.column("piece")[0].as_py()) != piece:
                piece, shard = at, Shard(*_unpack(row, width))
            yield Block(*_unpack(row, width, "a_")), shard, row


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[] for _ in names])], names)


def _positives(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, shard, _ in _pairs(batches, width):
            yield _table(list(positives(block, shard, k)), _FOUND)

    return run


def _negatives(width: int, k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, shard, row in _pairs(batches, width):
            known: dict[int, list[tuple[int, int]]] = {}
            for p in row.column("a_known")[0].as_py():
                known.setdefault(p["anchor_id"], []).append((p["vec_id"], p["score"]))
            yield _table(list(negatives(block, shard, known, k, low, high)), _MINED)

    return run


def mine(
    vectors: DataFrame,
    every: int = EVERY,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    block_rows: int = BLOCK,
    shard_rows: int = SHARD,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id is divisible by ``every``. ``low`` and ``high`` are hundredths of
    a positive's score between which its negatives' scores lie.
    """
    spark = configure(vectors.sparkSession)
    v = F.col(vector).cast("array<double>")
    usable = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & F.forall(v, finite))
    whole = F.transform(v, lambda x: F.floor(x * float(scale)).cast("double"))
    rows = usable.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), whole.alias("vector"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("one")).select("vec_id", "one.*")
    one = staged(spark, one, "vectors")
    anchor = F.col("vec_id") % every == 0
    size = one.agg(F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("anchors"), F.max(F.size("vector")).alias("width")).first()
    if not size["anchors"]:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    width = size["width"]
    filled = F.concat(F.col("vector"), F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector")))
    one = one.withColumn("vector", filled)

    wide = min(2 * spark.sparkContext.defaultParallelism, -(-size["n"] // LEAST))
    shards = max(-(-size["n"] // shard_rows), wide)
    dealt = one.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    dealt = dealt.repartition(shards, "part").sortWithinPartitions("part")
    packed = dealt.select("part", "vec_id", "label", "vector").mapInArrow(_packer(2 * shard_rows), _ROWS)
    packed = packed.withColumnRenamed("part", "shard").withColumn("piece", F.monotonically_increasing_id())
    packed = staged(spark, packed, "shards").repartition(shards, "shard")

    # Signs of the sums over fixed halves of the components: near vectors share most of them.
    def sign(i: int):
        total = F.aggregate(
            F.transform("vector", lambda x, at: F.when(F.pmod(F.xxhash64(F.lit(i), at), F.lit(2)) == 0, x).otherwise(-x)), F.lit(0.0), lambda a, b: a + b
        )
        return F.when(total >= 0, "1").otherwise("0")

    order = F.concat(*[sign(i) for i in range(SIGNS)])
    blocks = -(-size["anchors"] // block_rows)
    near = one.where(anchor).withColumn("order", order).repartitionByRange(blocks, "label", "order", "vec_id")
    near = near.sortWithinPartitions("label", "order", "vec_id").withColumn("part", F.spark_partition_id())
    near = near.select("part", "vec_id", "label", "vector").mapInArrow(_packer(block_rows), _ROWS)
    near = near.select(F.monotonically_increasing_id().alias("block"), *[F.col(c).alias("a_" + c) for c in ("ids", "labels", "vectors")])
    near = staged(spark, near, "blocks")

    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")

    def work(blocks_: DataFrame) -> DataFrame:
        """Blocks, about 64 kB each, go to every shard."""
        return blocks_.select("*", every_shard).repartition(shards, "shard").join(packed.hint("merge"), "shard")

    best = W.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    found = work(near).mapInArrow(_positives(width, n_positives), _FOUND)
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_positives).drop("rank")
    found = staged(spark, found, "positives")
    names = near.select("block", F.explode("a_ids").alias("anchor_id"))
    known = found.join(names, "anchor_id").groupBy("block").agg(F.collect_list(F.struct("anchor_id", "vec_id", "score")).alias("a_known"))
    near = staged(spark, near.join(known, "block"), "windows")
    mined = work(near).mapInArrow(_negatives(width, n_negatives, low, high), _MINED)
    best = W.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

