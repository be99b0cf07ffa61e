"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes over it also starts earlier: in a
document with a smaller id, or earlier in the same one.

Every string of that length has one anchor, the ``ANCHOR`` bytes in it with the
smallest hash. Consecutive starts with the same anchor form a piece; equal
strings lie in pieces with equal anchors, at the same distance from it. So
texts are cut into pieces, pieces are dealt out by anchor, and of equal pieces
all but the first go. An anchor with one piece left is done. Anchors
with several different pieces are where repeats begin, end or differ: their
pieces go into shards, every shard gets its suffix array and Burrows-Wheeler
transform, and the transforms are merged by refining their interleave one
character at a time. No suffix is sorted again. A boundary that shows up in
round h is a common prefix of h - 1, and what no boundary divides after
``length`` rounds are the repeated intervals: the earliest start in each stays.

An anchor with more than ``CROWDED`` different pieces would be too much for one
task; its strings are grouped by their 128-bit hashes instead, which Spark
combines before the shuffle. Both ways give the same starts.

Texts are UTF-8 bytes, null texts empty; those shorter than ``length`` have
nothing to remove. Rows that share an id, or have none, are ordered by text
(nulls last) and count as documents of their own. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.llm.common import utf8
from quayline.session import configure, staged

LENGTH = 100
ANCHOR = 32
CROWDED = 4_096
# Small enough for a core's cache.
SHARD_BYTES = 1 << 17
CHUNK_BYTES = 1 << 18
BUFFER_BITS = 20
_U = np.uint64


def _mixers(levels: int) -> list[tuple[np.uint64, np.uint64]]:
    rng = np.random.default_rng(1905)
    return [tuple(_U(x | 1) for x in rng.integers(1 << 62, 1 << 63, 2).tolist()) for _ in range(levels)]


_BYTES = np.random.default_rng(611).integers(0, 1 << 63, 256, dtype=np.int64).view(np.uint64) * _U(2) + _U(1)
_LEVELS = _mixers(6)


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32 and of the 64 bytes from each place; the ends of the arrays have no meaning."""
    h = _BYTES[data]
    of32 = h
    for level, (a, b) in enumerate(_LEVELS):
        step = 1 << level
        if len(h) <= step:
            break
        new = h * a
        new[:-step] += h[step:] * b
        new ^= new >> _U(29)
        h = new
        if level == 4:
            of32 = h
    return of32, h


def pieces_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH):
    """Pieces of the documents ``[start, end)`` in a buffer: anchor, identity, first start, number of starts."""
    valid = np.zeros(len(data) + 1, dtype=np.int32)
    long = ends - starts >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    if not valid.any():
        return (np.zeros(0, dtype=np.uint64),) * 2 + (np.zeros(0, dtype=np.int64),) * 2
    of32, of64 = _hashes(data)
    places = np.arange(len(data), dtype=np.uint64)
    low = _U((1 << BUFFER_BITS) - 1)
    key = (of32 & ~low) | places  # the leftmost of equal minima
    window = length - ANCHOR + 1
    width = 1
    while width * 2 <= window:
        key[:-width] = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < window:
        key[: width - window] = np.minimum(key[: width - window], key[window - width :])
    at = (key & low).astype(np.int64)
    change = np.ones(len(data), dtype=bool)
    change[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
    edge = np.flatnonzero(change)
    count = np.diff(np.append(edge, len(data)))
    good = valid[edge]
    first, count = edge[good], count[good]
    anchor = at[first]
    end = first + count + length - 1
    ident = _U(0)
    # Three 64-byte windows cover a piece.
    for place, (a, b) in zip((first, np.minimum(first + 52, end - 64), end - 64), _LEVELS):
        ident = (ident ^ of64[place]) * a
        ident ^= ident >> _U(31)
    ident = (ident + count.astype(np.uint64)) * _LEVELS[5][0]
    ident = (ident ^ (anchor - first).astype(np.uint64)) * _LEVELS[4][1]
    ident ^= ident >> _U(32)
    return of32[anchor], ident, first, count


def _cut(texts: list[bytes], length: int):
    """Buffers of whole documents, or of overlapping slices of one too long: bytes, starts, ends, document, offset."""
    limit = 1 << BUFFER_BITS
    held: list[tuple[bytes, int, int]] = []
    size = 0

    def buffer():
        data = np.frombuffer(b"".join(t for t, _, _ in held), dtype=np.uint8)
        ends = np.cumsum([len(t) for t, _, _ in held])
        return data, ends - [len(t) for t, _, _ in held], ends, np.array([d for _, d, _ in held]), np.array([o for _, _, o in held])

    for d, text in enumerate(texts):
        if len(text) < length:
            continue
        step = limit // 2
        for o in range(0, max(1, len(text) - length + 1), step):
            part = text if len(text) <= step else text[o : o + step + length - 1]
            if held and size + len(part) > limit:
                yield buffer()
                held, size = [], 0
            held.append((part, d, o))
            size += len(part)
            if len(text) <= step:
                break
    if held:
        yield buffer()


_PIECES = "anchor bigint, piece bigint, row bigint, at int, n int, again boolean"


def _pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch.column("row"))
            order = np.argsort(rows, kind="stable")
            texts = batch.column("text").take(pa.array(order)).to_pylist()
            rows = rows[order]
            parts: list = [[], [], [], [], []]
            for data, starts, ends, docs, offsets in _cut(texts, length):
                anchor, piece, first, count = pieces_of(data, starts, ends, length)
                slot = np.searchsorted(starts, first, side="right") - 1
                for to, value in zip(parts, (anchor, piece, rows[docs[slot]], first - starts[slot] + offsets[slot], count)):
                    to.append(value)
            if not parts[0]:
                continue
            anchor, piece, row, at, n = map(np.concatenate, parts)
            # Pieces come in order of row and place; those a batch has had before are settled, and joined to runs.
            again = pd.DataFrame({"a": anchor, "p": piece}).duplicated().to_numpy()
            fresh = ~again
            runs = _runs(row[again], at[again], n[again])
            # Settled runs need no anchor; their place deals them out.
            spread = (runs[0] ^ (runs[1] << 32)) * np.int64(-7046029254386353131)
            none = np.zeros(len(spread), dtype=np.int64)
            columns = (
                np.concatenate((anchor[fresh].view(np.int64), spread)),
                np.concatenate((piece[fresh].view(np.int64), none)),
                np.concatenate((row[fresh], runs[0])),
                np.concatenate((at[fresh], runs[1])).astype(np.int32),
                np.concatenate((n[fresh], runs[2])).astype(np.int32),
                np.concatenate((np.zeros(fresh.sum(), dtype=bool), np.ones(len(spread), dtype=bool))),
            )
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["anchor", "piece", "row", "at", "n", "again"])

    return run


def shard_transform(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and Burrows-Wheeler transform of a shard; bytes are one higher, 0 ends each text.

    Ends rank by the order of their texts, before all bytes. Suffixes that agree
    in more than ``depth`` characters may come in any order: a merge that looks
    at ``depth`` characters cannot tell them apart.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8) + np.uint8(1)
    stop = np.cumsum(sizes) - 1
    data[stop] = 0
    n = len(data)
    text = np.repeat(np.arange(len(texts)), sizes)
    left = stop[text] - np.arange(n)  # characters before the end
    # Seven characters to a number, then doubling.
    key = np.zeros(n, dtype=np.int64)
    for k in range(7):
        key[: n - k] |= np.where(left[: n - k] > k, data[k:].astype(np.int64), 0) << (8 * (6 - k))
    step = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if new[-1] == n - 1 or step > depth and not (left[order][1:][new[1:] == new[:-1]] < step).any():
            break
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        # Beyond a text's end, its number decides; real continuations rank after all of these.
        follow = text.copy()
        far = left >= step
        follow[far] = rank[np.flatnonzero(far) + step] + len(texts)
        key = rank * (n + len(texts) + 1) + follow
        step *= 2
    before = data[order - 1]
    before[np.isin(order, np.concatenate(([0], stop[:-1] + 1)))] = 0
    return order, before


def merge_transforms(transforms: list[np.ndarray], ends: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of shard transforms by the first ``depth`` characters, and common prefixes below it.

    Returns, for every place of the merged order, the shard it comes from and
    the length of the prefix it shares with its predecessor, ``depth`` if that
    is as long or longer. ``ends`` are the shards' numbers of texts.
    """
    shards = len(transforms)
    kind = np.uint8 if shards < 256 else np.uint16
    z = np.repeat(np.arange(shards, dtype=kind), [len(b) for b in transforms])
    fixed = np.repeat(np.arange(shards, dtype=kind), ends)
    n, stops = len(z), len(fixed)
    if n >= 1 << 24:
        raise ValueError("too many characters for one merge")
    lcp = np.full(n, depth, dtype=np.int32)
    head = np.zeros(n, dtype=bool)
    head[0] = True
    lcp[0] = 0
    symbols = np.empty(n, dtype=np.uint8)
    for h in range(1, depth + 1):
        for shard, transform in enumerate(transforms):
            symbols[z == shard] = transform
        order = np.argsort(symbols, kind="stable")
        # Block and character in one number move together.
        packed = np.cumsum(head, dtype=np.uint32)
        packed <<= np.uint32(8)
        packed |= symbols
        z, packed = z[order], packed[order]
        new = np.empty(n, dtype=bool)
        new[0] = True
        np.not_equal(packed[1:], packed[:-1], out=new[1:])
        # Ends come first, in the order of their texts, and are all different.
        z[:stops], new[:stops] = fixed, True
        if stops < n:
            new[stops] = True
        new |= head
        lcp[new & ~head] = h - 1
        head = new
        if head.all():
            break
    return z, lcp


def first_starts(texts: list[bytes], rows: np.ndarray, at: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES):
    """Of all starts of strings in the pieces, those that are the earliest with their string: row and place."""
    shards: list[list[int]] = [[]]
    size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > shard_bytes:
            shards.append([])
            size = 0
        shards[-1].append(i)
        size += len(t) + 1
    arrays, transforms, base, owner, inner = [], [], 0, [], []
    for members in shards:
        own = [texts[i] for i in members]
        order, bwt = shard_transform(own, length)
        arrays.append(order + base)
        transforms.append(bwt)
        sizes = np.array([len(t) + 1 for t in own])
        owner.append(np.repeat(members, sizes))
        inner.append(np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        base += int(sizes.sum())
    z, lcp = merge_transforms(transforms, [len(s) for s in shards], length)
    merged = np.empty(len(z), dtype=np.int64)
    merged[np.argsort(z, kind="stable")] = np.concatenate(arrays)
    owner, inner = np.concatenate(owner)[merged], np.concatenate(inner)[merged]
    room = np.array([len(t) for t in texts])[owner] - inner >= length
    interval = np.cumsum(lcp < length)[room]
    owner, inner = owner[room], inner[room]
    if not len(owner):
        return rows[:0], at[:0]
    # Order of documents and place in one number; members of an interval lie side by side.
    rank = np.unique(rows, return_inverse=True)[1][owner]
    place = at[owner] + inner
    begin = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
    least = np.minimum.reduceat((rank << 40) | place, begin)
    return np.unique(rows)[least >> 40], least & ((1 << 40) - 1)


def _needed(texts: list[bytes], anchors: np.ndarray, length: int):
    """Parts of the pieces that can hold a string some other piece has: owner, first start, number of starts.

    A string holds its anchor and 32 bytes more to the right of it, or to the
    left. Where no other piece agrees in these 64 bytes, the starts on that
    side are single.
    """
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    of32, of64 = _hashes(np.frombuffer(b"".join(texts), dtype=np.uint8))
    owner = np.repeat(np.arange(len(texts)), sizes)
    inner = np.arange(len(owner)) - begin[owner]
    starts = sizes - length + 1
    # The anchor is the first place with its hash that lies in the first string.
    match = np.flatnonzero((of32.view(np.int64) == anchors[owner]) & (inner <= length - ANCHOR) & (inner >= starts[owner] - 1))
    found, where = np.unique(owner[match], return_index=True)
    place = inner[match][where]
    margin = length - 2 * ANCHOR
    right = place - (starts[found] - 1) <= margin
    left = place >= ANCHOR
    agree = np.zeros((2, len(found)), dtype=bool)
    for side, (has, shift) in enumerate(((right, 0), (left, -ANCHOR))):
        at = (begin[found] + place + shift)[has]
        _, back, count = np.unique(of64[at], return_inverse=True, return_counts=True)
        agree[side, has] = count[back] > 1
    # Starts up to `place - ANCHOR` see the left side, those from `place - margin` on the right side.
    low = np.where(agree[1], 0, np.maximum(0, place - margin))
    high = np.where(agree[0], starts[found], np.minimum(starts[found], place - ANCHOR + 1))
    some = agree.any(axis=0) & (low < high)
    return found[some], low[some], (high - low)[some]


def _runs(row: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted ranges of starts with those joined that touch."""
    if not len(row):
        return row, place, n
    cut = np.ones(len(row), dtype=bool)
    cut[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + n[:-1])
    edge = np.flatnonzero(cut)
    return row[edge], place[edge], np.add.reduceat(n, edge)


def _as_runs(row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Starts as runs (row, at, n)."""
    order = np.lexsort((place, row))
    row, place, n = _runs(row[order], place[order], np.ones(len(row), dtype=np.int64))
    columns = (row.astype(np.int64), place.astype(np.int32), n.astype(np.int32))
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["row", "at", "n"])


_RUNS = "row bigint, at int, n int"


def _merge(length: int):
    """Pieces sorted by anchor; whole anchors are gathered up to a chunk, then merged."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        rows, at = np.asarray(t.column("row")), np.asarray(t.column("at")).astype(np.int64)
        texts = t.column("bytes").to_pylist()
        owner, low, n = _needed(texts, np.asarray(t.column("anchor")), length)
        parts = [texts[i][a : a + c + length - 1] for i, a, c in zip(owner.tolist(), low.tolist(), n.tolist())]
        row, place = rows[:0], at[:0]
        if parts:
            row, place = first_starts(parts, rows[owner], at[owner] + low, length)
        # What was not compared is single and stays.
        starts = np.array([len(x) for x in texts]) - length + 1
        head, tail = starts.copy(), np.zeros(len(texts), dtype=np.int64)
        head[owner], tail[owner] = low, starts[owner] - low - n
        count = np.concatenate((head, tail))
        begin = np.concatenate((at, at + starts - tail))
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        single = np.repeat(begin, count) + inner
        return _as_runs(np.concatenate((row, np.repeat(np.concatenate((rows, rows)), count))), np.concatenate((place, single)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            anchors = np.asarray(batch.column("anchor"))
            sizes = np.fromiter((len(b) for b in batch.column("bytes").to_pylist()), dtype=np.int64, count=len(anchors))
            begin = 0
            for i in range(len(anchors)):
                last = held[-1].column("anchor")[-1].as_py() if held and i == begin else None
                fresh = anchors[i] != (anchors[i - 1] if i > begin else last)
                if fresh and size >= CHUNK_BYTES:
                    held.append(batch.slice(begin, i - begin))
                    yield solve([b for b in held if b.num_rows])
                    held, size, begin = [], 0, i
                size += sizes[i]
            if begin < len(anchors):
                held.append(batch.slice(begin))
        if held:
            yield solve(held)

    return run


def _bytes_of(length: int, limit: int, crowded: bool):
    """Bytes of the pieces to compare, from the documents and their lists of such pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text, marks in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
                for p in marks:
                    if (p["m"] > limit) == crowded:
                        out.append((p["anchor"], row, p["at"], text[p["at"] : p["at"] + p["n"] + length - 1]))
            if not out:
                continue
            if not crowded:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["anchor", "row", "at", "bytes"])
                continue
            strings = [(t[i : i + length], row, at + i) for _, row, at, t in out for i in range(len(t) - length + 1)]
            digests = np.frombuffer(b"".join(hashlib.blake2b(s, digest_size=16).digest() for s, _, _ in strings), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests[::2]), pa.array(digests[1::2]),
                    pa.array([s[1] for s in strings], pa.int64()), pa.array([s[2] for s in strings], pa.int32()),
                ],
                ["one", "two", "row", "at"],
            )

    return run


def covered_bytes(size: int, gone: tuple, stay: tuple, length: int) -> np.ndarray:
    """Which bytes of a document go: all under the starts in the runs ``gone`` that are in no run of ``stay``."""
    starts = size - length + 1
    if starts <= 0 or not len(gone[0]):
        return np.zeros(size, dtype=bool)
    again = np.zeros(starts + 1, dtype=np.int32)
    kept = np.zeros(starts + 1, dtype=np.int32)
    for to, (at, n) in ((again, gone), (kept, stay)):
        np.add.at(to, at, 1)
        np.add.at(to, at + n, -1)
    again = (np.cumsum(again[:-1]) > 0) & (np.cumsum(kept[:-1]) <= 0)
    cover = np.zeros(size + 1, dtype=np.int32)
    cover[:starts] += again
    cover[length : length + starts] -= again
    return np.cumsum(cover[:-1]) > 0


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A column of lists of runs: first item of each row (and the end), places, numbers."""
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    items = column.flatten()
    return np.concatenate(([0], np.cumsum(sizes))), np.asarray(items.field("at")), np.asarray(items.field("n"))


def _finish(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            out: list = [[], [], [], []]
            m_slot, m_at, m_n = _flat(batch.column("marks"))
            k_slot, k_at, k_n = _flat(batch.column("stay"))
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                m, k = slice(m_slot[i], m_slot[i + 1]), slice(k_slot[i], k_slot[i + 1])
                gone = covered_bytes(len(text), (m_at[m], m_n[m]), (k_at[k], k_n[k]), length)
                spans, rest = [], text
                if gone.any():
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    spans = [{"first": int(a), "last": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    rest = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                for to, value in zip(out, (len(text), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())):
                    to.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], kind), pa.array(out[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"],
            )

    return run


def _numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(row, doc_id, text)`` with a row number that orders documents; the id itself where it is a key."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    odd = rows.where("doc_id is null").limit(1).count() or rows.groupBy("doc_id").count().where("count > 1").limit(1).count()
    if not odd:
        return rows.select(F.col("doc_id").alias("row"), "doc_id", "text")
    ordered = rows.orderBy(F.col("doc_id").asc_nulls_last(), "text").withColumn("row", F.monotonically_increasing_id())
    return staged(spark, ordered.select("row", "doc_id", "text"), "numbered")


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept_sha256)`` for every row of ``docs``."""
    spark = configure(docs.sparkSession)
    if not 2 * ANCHOR < length <= 128:
        raise ValueError("three 64-byte windows cover the pieces of strings of 65 to 128 bytes only")
    rows = _numbered(docs, doc_id, text)
    pieces = rows.select("row", "text").mapInArrow(_pieces(length), _PIECES).repartition("anchor")
    same = W.partitionBy("anchor", "again", "piece").orderBy("row", "at")
    pieces = pieces.withColumn("nth", F.when(~F.col("again"), F.row_number().over(same)).otherwise(2))
    different = F.count(F.when(F.col("nth") == 1, 1)).over(W.partitionBy("anchor", "again"))
    pieces = pieces.withColumn("m", F.when(F.col("nth") == 1, different).otherwise(0).cast("int"))
    # A piece that is alone at its anchor stays and needs no mention: what is marked goes, but for the starts that win.
    marks = pieces.where("m <> 1").select("row", "at", "n", "m", F.when(F.col("m") > 1, F.col("anchor")).alias("anchor"))
    marks = staged(spark, marks, "marks")
    by_row = marks.groupBy("row").agg(F.collect_list(F.struct("at", "n", "m", "anchor")).alias("marks"))
    # The texts are shuffled once; both uses read the same exchange.
    joined = rows.join(by_row, "row", "left")
    compared = joined.where(F.exists("marks", lambda p: p["m"] > 1))
    compared = compared.select("row", "text", F.filter("marks", lambda p: p["m"] > 1).alias("marks"))
    pieces = compared.mapInArrow(_bytes_of(length, crowded, False), "anchor bigint, row bigint, at int, bytes binary")
    merged = pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_merge(length), _RUNS)
    if marks.where(F.col("m") > crowded).limit(1).count():
        strings = compared.mapInArrow(_bytes_of(length, crowded, True), "one bigint, two bigint, row bigint, at int")
        earliest = strings.groupBy("one", "two").agg(F.min(F.struct("row", "at")).alias("first"))
        merged = merged.unionByName(earliest.select("first.row", "first.at", F.lit(1).alias("n")))
    stay = merged.groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("stay"))
    final = joined.join(stay, "row", "left").select("doc_id", "text", "marks", "stay")
    return final.mapInArrow(
        _finish(length),
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<first:bigint,last:bigint>>, kept_sha256 string",
    )
