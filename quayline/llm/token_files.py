"""Texts as token-id files: flat unsigned integers plus 64-bit document offsets.

Rows are ordered by id across range partitions. Each task writes three files:
``.bin`` with the ids back to back (16 bits wide where the vocabulary allows,
else 32), ``.idx`` with int64 offsets (one more than documents) and ``.doc`` with
the int64 document ids, a byte per document for null ids behind them. A
manifest names the files of the attempts that succeeded, so repeated or killed
attempts leave nothing that is ever read. Where a partition's ids start among
all ids follows from the prefix sum of the partitions' counts.

Null and empty texts hold just the end id. Null ids sort first, rows that share
an id are ordered by their text, an empty table gives an empty manifest.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.llm.common import small_batches, tasks_for, worker_state
from quayline.session import configure, scratch_path, staged
from quayline.sources import filesystem
from quayline.sources.binary import arrow_options, open_filesystem

END_ID = 2
BATCH = 512
# Words kept by each of the cache's two generations, the bytes of the longest of them, characters cut into words at a time,
# words encoded at a time (the library's result for one takes about half a kilobyte) and words of a text they are joined to.
CACHED, LONGEST, TOGETHER, WORDS, JOINED = 400_000, 64, 1 << 21, 4_096, 256
MANIFEST = "part int, path string, n_docs bigint, n_tokens bigint, width int"
# No pre-token of a byte-level BPE crosses these cuts: before white space, and between a Latin letter and ASCII punctuation.
_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, list(b" \t\n\r\x0b\x0c"))
_LETTER = np.isin(_BYTES | 32, np.arange(ord("a"), ord("z") + 1)) & (_BYTES < 0x80)
_PUNCTUATION = np.isin(_BYTES, list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))
# Other white space makes cuts ambiguous, as does a special token's text; such texts are encoded whole.
_WHOLE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]|<\|")


def _ambiguous(text: str) -> bool:
    if text.isascii():
        return "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f")
    return _WHOLE.search(text) is not None


def _word_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the words of UTF-8 bytes begin; ``texts`` are the places where a text does."""
    space, before = _SPACE[data], data[:-1]
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    ends = _LETTER[before]
    # The second byte of U+00C0 to U+024F, without the signs of multiplication and division, ends a letter as well.
    lead = np.flatnonzero((before >= 0xC3) & (before <= 0xC9))
    first, second = data[lead], data[lead + 1]
    letter = np.where(first == 0xC3, (second != 0x97) & (second != 0xB7), (first != 0xC9) | (second <= 0x8F))
    second = lead[letter] + 1
    ends[second[second < len(ends)]] = True
    cut[1:] |= ends & _PUNCTUATION[data[1:]]
    cut[texts[texts < len(data)]] = True
    return np.flatnonzero(cut)


def _pieces(values: pa.LargeBinaryArray, at: slice | np.ndarray = slice(None)) -> list[bytes]:
    """The values, or what lies between some of them, without a scalar object for each."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1][at].tolist()
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Encoder:
    """Token ids of texts as packed bytes, with a bounded cache of words already encoded.

    The words of many texts are told apart together, and those not seen yet are encoded together.
    The cache has two generations: words met again while the younger one fills up are taken over into it.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.kind.itemsize]
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        pre = type(self.tokenizer.pre_tokenizer).__name__
        self.by_word = pre == "ByteLevel" and self.tokenizer.normalizer is None
        if self.by_word:
            # A token of a byte-level vocabulary has one character for each byte.
            tokens = self.tokenizer.get_vocab(with_added_tokens=True)
            self.n_bytes = np.zeros(max(tokens.values(), default=0) + 1, dtype=np.int64)
            for token, i in tokens.items():
                self.n_bytes[i] = len(token)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word. Words that follow white space and have none at their end are joined, as cuts lie between them in any text."""
        joins = [bool(_SPACE[w[0]]) and not _SPACE[w[-1]] for w in words]
        alone = [w for w, j in zip(words, joins) if not j]
        some = [w for w, j in zip(words, joins) if j]
        joined: list[bytes] = []
        groups = [some[i : i + JOINED] for i in range(0, len(some), JOINED)]
        for group, ids in zip(groups, self._encode([b"".join(g).decode() for g in groups])):
            ends = np.cumsum(self.n_bytes[np.frombuffer(ids, dtype=self.kind)])
            wanted = np.cumsum(np.fromiter(map(len, group), dtype=np.int64, count=len(group)))
            at = np.searchsorted(ends, wanted)
            if at[-1] == len(ends) - 1 and (ends[at] == wanted).all():
                at = [0, *((at + 1) * self.kind.itemsize).tolist()]
                joined += [ids[a:b] for a, b in zip(at[:-1], at[1:])]
            else:  # a vocabulary that does not have all bytes
                joined += self._encode([w.decode() for w in group])
        one, other = iter(joined), iter(self._encode([w.decode() for w in alone]))
        return [next(one if j else other) for j in joins]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of these different words, which are in the cache from now on."""
        found = list(map(self.cache.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missing:
            found[i] = self.old.get(words[i])
            if found[i] is None:
                new.append(i)
        for k in range(0, len(new), WORDS):
            some = new[k : k + WORDS]
            for i, ids in zip(some, self._encode_words([words[i] for i in some])):
                found[i] = ids
        if len(self.cache) + len(missing) > CACHED:
            self.old, self.cache, missing = self.cache, {}, range(len(words))
        self.cache.update((words[i], found[i]) for i in missing if len(words[i]) <= LONGEST)
        return found

    def _by_word(self, texts: list[bytes]) -> Iterator[bytes]:
        data = b"".join(texts)
        if not data:
            yield from (b"" for _ in texts)
            return
        edges = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))))
        starts = _word_starts(np.frombuffer(data, dtype=np.uint8), edges[:-1])
        buffers = [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        ids = pa.array(self._ids(_pieces(words.dictionary)), pa.large_binary()).take(words.indices)
        yield from _pieces(ids, np.searchsorted(starts, edges))

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        whole = [_ambiguous(t) for t in texts]
        by_word = self._by_word([t.encode() for t, w in zip(texts, whole) if not w])
        for text, w in zip(texts, whole):
            yield self._encode([text])[0] if w else next(by_word)

    def __call__(self, texts: Iterable[str]) -> Iterator[bytes]:
        if not self.by_word:
            yield from (self._encode([t])[0] if t else b"" for t in texts)
            return
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)


def _writer(vocabulary: str, folder: str, options: dict, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_state(f"encoder_{zlib.crc32(vocabulary.encode())}", lambda: Encoder(vocabulary))
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        part = TaskContext.get().partitionId()
        fs, root = open_filesystem(folder, options)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        sizes, ids, nulls, out = [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or fs.open_output_stream(f"{root}/{name}.bin")
            for ids_of in encoder(text.as_py() for text in batch.column("text")):
                data = ids_of + end
                sizes.append(len(data) // encoder.kind.itemsize)
                out.write(data)
            column = batch.column("doc_id")
            ids.append(np.asarray(column.fill_null(0)))
            nulls.append(np.asarray(column.is_null()).astype(np.uint8))
        if out is None:
            return
        out.close()
        offsets = np.concatenate(([0], np.cumsum(np.array(sizes, dtype="<i8"))))
        with fs.open_output_stream(f"{root}/{name}.idx") as f:
            f.write(offsets.astype("<i8").tobytes())
        with fs.open_output_stream(f"{root}/{name}.doc") as f:
            f.write(np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(nulls).tobytes())
        row = [[part], [f"{folder}/{name}"], [len(sizes)], [int(offsets[-1])], [encoder.kind.itemsize]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds)], ["part", "path", "n_docs", "n_tokens", "width"]
        )

    return run


def write_tokens(
    docs: DataFrame, vocabulary_path: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Write the files below ``folder`` and return the manifest, bases included, as a table.

    ``vocabulary_path`` is a tokenizer file of the driver; its content, a few
    megabytes whatever the corpus, travels with the tasks.
    """
    spark = configure(docs.sparkSession)
    folder = filesystem.qualified(spark, folder)
    filesystem.make_directory(spark, folder)
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The text decides between rows that share an id, also about the partition: no id is a hot spot.
    rows = rows.repartitionByRange(tasks_for(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )
    run = _writer(vocabulary, folder, arrow_options(spark, folder), end_id)
    with small_batches(spark):
        written = staged(spark, rows.mapInArrow(run, MANIFEST), "manifest")
    # One row per partition, so a single window over all of them stays small.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(b) for c, b in (("n_docs", "base_doc"), ("n_tokens", "base_token"))]
    return staged(spark, written.select("*", *bases), "manifest")


def _mapped(fs, root: str, local: bool, suffix: str, kind: str) -> np.ndarray:
    if local:
        return np.memmap(root + suffix, dtype=kind, mode="r")
    with fs.open_input_file(root + suffix) as f:
        return np.frombuffer(f.read(), dtype=kind)


def _reader(options: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, root = open_filesystem(row["path"], options)
                local = row["path"].startswith("file:")
                tokens = _mapped(fs, root, local, ".bin", f"<u{row['width']}")
                offsets = _mapped(fs, root, local, ".idx", "<i8")
                raw = _mapped(fs, root, local, ".doc", "u1")
                ids, null = raw[: 8 * row["n_docs"]].view("<i8"), raw[8 * row["n_docs"] :].astype(bool)
                for at in range(0, row["n_docs"], BATCH):
                    cut = offsets[at : at + BATCH + 1]
                    crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[at : at + BATCH], pa.int64(), mask=null[at : at + BATCH]),
                            pa.array(cut[:-1] + row["base_token"], pa.int64()),
                            pa.array(np.diff(cut), pa.int64()),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, read from the files the manifest names."""
    options = arrow_options(spark, scratch_path(spark, "tokens"))
    parts = manifest.repartitionByRange(max(1, manifest.count()), "part")
    return parts.mapInArrow(_reader(options), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
