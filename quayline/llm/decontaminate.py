"""Benchmark decontamination with an FM-index per shard of the corpus.

A shard is one batch of documents. Its words become numbers of the benchmark's
vocabulary; a phrase can only lie in a run of word pairs that the benchmark
has, so everything outside of such runs is left out before indexing. The rest
gets a suffix array, its Burrows-Wheeler transform and a wavelet matrix; all
phrases are searched backwards at once by rank pairs, occurrences are located
from every eighth suffix position, and the words they cover merge into spans.

The phrases of at most ``BLOCK_BYTES`` of benchmark text travel with the tasks; a
larger benchmark is searched in several such blocks, one after the other, each
over the original texts; the driver holds one block at a time.

Null and empty texts have no words and no hits. An item without words has no
phrase. An item without an id is searched and cut like any other and its words
count as hit, but it is in no list of items and not in their number. Repeated
rows are judged each for itself, items that share an id count once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import give_back, utf8
from quayline.session import configure, staged

WINDOW = 10
SAMPLE = 8
BLOCK_BYTES = 16 * 1024 * 1024
#: Bytes outside words become blanks, A-Z become a-z; bytes from 0x80 on belong to words.
WORD_BYTES = bytes(
    c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
FOUND = "row_id bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, bytes array<struct<first:bigint,last:bigint>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WaveletMatrix:
    """Rank of any symbol in a prefix of a sequence, level by level from the highest bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros, self.ones = bits, [], []
        row = symbols
        for level in range(bits - 1, -1, -1):
            bit = (row >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int64))))
            self.zeros.append(int(len(row) - self.ones[-1][-1]))
            row = np.concatenate((row[bit == 0], row[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        start, end = np.zeros_like(end), end.copy()
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            up = (symbol >> (self.bits - 1 - level)) & 1 == 1
            s1, e1 = ones[start], ones[end]
            start = np.where(up, zeros + s1, start - s1)
            end = np.where(up, zeros + e1, end - e1)
        return end - start


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by doubling the compared length."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    ordered = seq[order]
    rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
    step = 1
    while step < n and rank[order[-1]] < n - 1:
        second = np.zeros(n, dtype=np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        step *= 2
    return order


class FMIndex:
    """Counts and locates phrases over one shard; inside, symbols are one higher and 0 closes the text."""

    def __init__(self, seq: np.ndarray, alphabet: int):
        text = np.concatenate((seq + 1, [0]))
        sa = suffix_array(text)
        self.n = len(text)
        self.bwt = text[sa - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet + 1))))
        self.wavelet = WaveletMatrix(self.bwt, max(1, int(alphabet + 1).bit_length()))
        self.marked = sa % SAMPLE == 0
        self.mark_rank = np.cumsum(self.marked) - 1
        self.samples = sa[self.marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges ``[lo, hi)`` of equally long phrases, one per row."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, k] + 1
            lo[live] = self.before[symbol] + self.wavelet.rank(symbol, lo[live])
            hi[live] = self.before[symbol] + self.wavelet.rank(symbol, hi[live])
            live = live[lo[live] < hi[live]]
            if not len(live):
                break
        hi[np.setdiff1d(np.arange(len(phrases)), live)] = 0
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: steps back until a sampled position."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        walk = np.flatnonzero(~self.marked[at])
        while len(walk):
            symbol = self.bwt[at[walk]]
            at[walk] = self.before[symbol] + self.wavelet.rank(symbol, at[walk])
            steps[walk] += 1
            walk = walk[~self.marked[at[walk]]]
        return self.samples[self.mark_rank[at]] + steps


class Phrases:
    """The benchmark's distinct windows as numbered words, by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                named = owners[tuple(ids[i : i + window])]
                if item is not None:
                    named.add(item)
        self.vocabulary = vocabulary
        self.alphabet = len(vocabulary) + 1
        by_length = defaultdict(list)
        for phrase, named in owners.items():
            by_length[len(phrase)].append((phrase, sorted(named)))
        self.by_length = {
            n: (np.array([p for p, _ in found], dtype=np.int64), [o for _, o in found]) for n, found in by_length.items()
        }
        pairs = [p[:, i] * self.alphabet + p[:, i + 1] for p, _ in self.by_length.values() for i in range(p.shape[1] - 1)]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, dtype=np.int64)
        self.single = np.zeros(self.alphabet, dtype=bool)
        if 1 in self.by_length:
            self.single[self.by_length[1][0][:, 0]] = True
        self.shortest = min((n for n in self.by_length if n > 1), default=2)

    def candidates(self, ids: np.ndarray) -> np.ndarray:
        """Positions of words that can be part of a phrase."""
        pair = np.zeros(len(ids), dtype=bool)
        both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        if len(both) and len(self.pairs):
            code = ids[both] * self.alphabet + ids[both + 1]
            slot = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            pair[both] = self.pairs[slot] == code
        # Runs of known pairs that are long enough for the shortest phrase of two words or more.
        edge = np.flatnonzero(np.diff(np.concatenate(([0], pair.view(np.int8), [0]))))
        first, last = edge[::2], edge[1::2]
        long = last - first >= self.shortest - 1
        mark = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(mark, first[long], 1)
        np.add.at(mark, last[long] + 1, -1)
        return np.flatnonzero((np.cumsum(mark[:-1]) > 0) | self.single[ids])


def search_shard(texts: list[bytes], phrases: Phrases):
    """For each text: number of words, spans of hit words ``[first, last)``, names of the items found."""
    get = phrases.vocabulary.get
    counts, pieces = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        pieces.append(np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words)))
        pieces.append(np.zeros(1, dtype=np.int64))  # keeps documents apart
    starts = np.concatenate(([0], np.cumsum(np.array(counts, dtype=np.int64) + 1)))
    ids = np.concatenate(pieces) if pieces else np.zeros(1, dtype=np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    kept = phrases.candidates(ids)
    if not len(kept):
        return counts, spans, items
    # The shard's text: what is kept, with a zero wherever something between was left out.
    gap = np.concatenate(([0], (np.diff(kept) > 1).astype(np.int64)))
    place = np.arange(len(kept)) + np.cumsum(gap)
    seq = np.zeros(place[-1] + 1, dtype=np.int64)
    seq[place] = ids[kept]
    origin = np.full(len(seq) + 1, -1, dtype=np.int64)
    origin[place] = kept
    index = FMIndex(seq, phrases.alphabet)
    hit = np.zeros(len(ids) + 1, dtype=np.int64)
    for length, (rows, owners) in phrases.by_length.items():
        lo, hi = index.search(rows)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        many = (hi - lo)[found]
        which = np.repeat(found, many)
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = origin[index.locate(lo[which] + within)]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + length, -1)
        doc = np.searchsorted(starts, at, side="right") - 1
        for d, p in np.unique(np.stack((doc, which), axis=1), axis=0):
            items[d].update(owners[p])
    covered = (np.cumsum(hit[:-1]) > 0).view(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0]))))
    for first, last in zip(edge[::2], edge[1::2]):
        d = int(np.searchsorted(starts, first, side="right")) - 1
        spans[d].append((int(first - starts[d]), int(last - starts[d])))
    return counts, spans, items


def byte_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as byte ranges of the text."""
    blank = np.frombuffer(text.translate(WORD_BYTES), dtype=np.uint8) == 32
    edge = np.flatnonzero(np.diff(np.concatenate(([1], blank.view(np.int8), [1]))))
    begin, end = edge[::2], edge[1::2]
    return [(int(begin[a]), int(end[b - 1])) for a, b in spans]


def _search(phrases: Phrases):
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, spans, items = search_shard(texts, phrases)
            named = lambda found: pa.array([[{"first": a, "last": b} for a, b in s] for s in found], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    named(spans),
                    named([byte_spans(t, s) if s else [] for t, s in zip(texts, spans)]),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "spans", "bytes", "items"],
            )

    return run


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[int, Iterator[Phrases]]:
    """The number of blocks of bounded size, and the benchmark's phrases block by block: none is built before it is asked for."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), utf8(text).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return blocks, (
        Phrases([(r["item"], bytes(r["text"])) for r in rows.where(part == b).collect()]) for b in range(blocks)
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, spans, bytes, items)`` per row of ``docs``: hit spans in words and in bytes, sorted item ids."""
    spark = configure(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    n, blocks = benchmark_blocks(benchmark, item_id, item_text)
    if n == 1:
        return rows.mapInArrow(_search(next(blocks)), FOUND.replace("row_id", "doc_id"))
    numbered = staged(spark, rows.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
    found = _found(numbered, blocks).join(numbered.select("row_id", "doc_id"), "row_id")
    return found.select("doc_id", "n_words", "spans", "bytes", "items")


def _found(numbered: DataFrame, blocks: Iterator[Phrases]) -> DataFrame:
    """What all blocks find in the texts of ``numbered(row_id, text)``, one row each.

    Every block searches the texts as they are, and what it finds is written
    before the next is built; the spans of all blocks unite at the end.
    """
    spark = numbered.sparkSession
    rows, found = numbered.select(F.col("row_id").alias("doc_id"), "text"), None
    for block in blocks:
        one = rows.mapInArrow(_search(block), FOUND.replace("row_id", "doc_id")).withColumnRenamed("doc_id", "row_id")
        one = staged(spark, one, "found")
        found = one if found is None else found.unionByName(one)
    joined = found.groupBy("row_id").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list(F.arrays_zip("spans", "bytes"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    united = joined.withColumn("hits", _united("hits"))
    return united.select("row_id", "n_words", F.col("hits.spans").alias("spans"), F.col("hits.bytes").alias("bytes"), "items")


def _united(column: str):
    """Hits whose words overlap or touch merged into one, with the bytes from the first to the last of these."""
    span = "struct<first:bigint,last:bigint>"
    last = "element_at(acc, -1)"
    merged = ", ".join(
        f"'{c}', named_struct('first', {last}.{c}.first, 'last', greatest({last}.{c}.last, x.{c}.last))" for c in ("spans", "bytes")
    )
    return F.expr(
        f"""aggregate(array_sort({column}), cast(array() as array<struct<spans:{span},bytes:{span}>>), (acc, x) ->
            if(size(acc) > 0 and {last}.spans.last >= x.spans.first,
               concat(slice(acc, 1, size(acc) - 1), array(named_struct({merged}))),
               concat(acc, array(x))))"""
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of the items from the spans found."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["last"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit spans cut out of the texts; documents of which no word is left go.

    Every other column stays, ``n_chars`` follows the text where there is such a column of whole numbers.
    """
    n, blocks = benchmark_blocks(benchmark)
    if n == 1:
        return docs.mapInArrow(_cut(next(blocks)), docs.schema)
    # No block sees what another has cut: all spans are those of the original text.
    spark = configure(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), utf8("text").alias("text"), F.monotonically_increasing_id().alias("row_id"))
    numbered = staged(spark, rows, "numbered")
    found = _found(numbered, blocks).where("size(spans) > 0").select("row_id", "n_words", "spans", "bytes")
    joined = numbered.select("row", "row_id").join(found, "row_id", "left")
    return joined.select("row", "n_words", "spans", "bytes").mapInArrow(_cut_found, docs.schema)


def _cut(phrases: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            counts, spans, _ = search_shard(texts, phrases)
            yield _rest(batch, counts, spans, [byte_spans(t, s) if s else [] for t, s in zip(texts, spans)])
        batch = texts = counts = spans = None
        give_back()

    return run


def _cut_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = lambda c: [[(x["first"], x["last"]) for x in s or ()] for s in batch.column(c).to_pylist()]
        rows = batch.column("row")
        names = [rows.type.field(i).name for i in range(rows.type.num_fields)]
        yield _rest(pa.RecordBatch.from_arrays(rows.flatten(), names), batch.column("n_words").to_pylist(), pairs("spans"), pairs("bytes"))


def _rest(batch: pa.RecordBatch, counts: list[int], spans: list[list[tuple[int, int]]], cuts: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    """The rows without what is cut from their texts."""
    new = batch.column("text").to_pylist()
    keep = []
    for i, (hit, cut) in enumerate(zip(spans, cuts)):
        if not hit or sum(b - a for a, b in hit) < counts[i]:
            keep.append(i)
        if hit:
            text, left, at = new[i].encode(), [], 0
            for a, b in cut:
                left.append(text[at:a])
                at = b
            new[i] = b"".join([*left, text[at:]]).decode()
    columns = [
        pa.array(new, batch.schema.field(c).type) if c == "text"
        else pa.array([len(t) if t is not None and h else n for t, h, n in zip(new, spans, batch.column(c).to_pylist())], batch.schema.field(c).type) if c == "n_chars" and pa.types.is_integer(batch.schema.field(c).type)
        else batch.column(c)
        for c in batch.schema.names
    ]
    return pa.RecordBatch.from_arrays(columns, batch.schema.names).take(pa.array(keep, pa.int64()))
