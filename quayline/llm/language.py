"""Language identification by compression.

Every language gets a raw-content zstandard dictionary of sample texts. A text
is encoded with each of them; the language whose dictionary gives the smallest
output wins. Where the runner-up is nearly as small, the decision is rejected.
Texts are lower-cased, reduced to letters and single blanks, and encoded whole
in blocks of ``BLOCK`` bytes: a long text would otherwise serve as its own
dictionary, and the languages would come out alike.

The dictionaries come from a bounded sample: per language the ``DOCS`` labelled
documents with the smallest hashes of their ids, ``PIECE`` characters of each,
from a hashed place.

Extra columns are ignored and may have any name. An empty table has no dictionaries and an empty result.
Null texts and texts without a letter are ``und`` and rejected, with score 0.
Rows repeat and tie freely; equal sizes go to the alphabetically first
language. Without any labelled row everything is ``und``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.llm.common import give_back, worker_state
from quayline.session import configure

DOCS = 200
SHARES = 64
PIECE = 500
LEVEL = 6
BLOCK = 1024
MARGIN = 0.004
# Dictionaries travel with every task, about a hundred kilobytes each: more languages than this are refused.
LANGUAGES = 500
UNDETERMINED = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    return _NO_LETTERS.sub(" ", text.lower()).encode()


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = DOCS, piece: int = PIECE) -> dict[str, bytes]:
    """Raw dictionary content by language; at most ``docs * piece`` bytes each, whatever the corpus size."""
    spark = configure(labelled.sparkSession)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    names = rows.select("lang").distinct().limit(LANGUAGES + 1).count()
    if names > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages are labelled")
    # Ids alone are ranked, within shares of a language first: no task gets more of one language than the shares' best.
    keys = rows.select("lang", "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("key")).where("doc_id is not null").distinct()
    keys = keys.withColumn("share", F.pmod("key", F.lit(SHARES)))
    for within in (["lang", "share"], ["lang"]):
        rank = F.row_number().over(W.partitionBy(*within).orderBy("key", "doc_id"))
        keys = keys.withColumn("rank", rank).where(F.col("rank") <= docs).drop("rank")
    chosen = keys.select("doc_id").distinct()
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - piece + 1, F.lit(1))).cast("int") + 1
    picked = rows.join(F.broadcast(chosen), "doc_id", "left_semi")
    pieces = picked.select("lang", "doc_id", F.substring("text", start, F.lit(piece)).alias("piece"))
    # Rows that share an id count once, so that what reaches the driver keeps its bound.
    pieces = pieces.groupBy("lang", "doc_id").agg(F.min("piece").alias("piece"))
    found: dict[str, list[str]] = {}
    seen = set()
    for r in sorted(pieces.collect(), key=lambda r: (r["lang"], str(r["doc_id"]), r["piece"])):
        if r["piece"] not in seen and len(found.setdefault(r["lang"], [])) < docs:
            seen.add(r["piece"])
            found[r["lang"]].append(r["piece"])
    return {k: b" ".join(map(letters, v)) for k, v in found.items() if v}


class Identifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.names = sorted(dictionaries)
        self.encoders = []
        for name in self.names:
            d = zstd.ZstdCompressionDict(dictionaries[name], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.encoders.append(
                zstd.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_dict_id=False)
            )

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and score: the share of the runner-up's size that the language saves."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        data = letters(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(e.compress(b)) for b in blocks) for e in self.encoders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
        return self.names[best], (second - sizes[best]) / second


def _key(dictionaries: dict[str, bytes], level: int) -> str:
    content = b"\0".join(k.encode() + b"\1" + v for k, v in sorted(dictionaries.items()))
    return f"languages_{zlib.crc32(content)}_{level}"


def _identify(dictionaries: dict[str, bytes], level: int, margin: float):
    key = _key(dictionaries, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = worker_state(key, lambda: Identifier(dictionaries, level))
        for batch in batches:
            found = [identify(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in batch.schema.names if c != "text"],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[0] == UNDETERMINED or f[1] < margin for f in found], pa.bool_()),
                ],
                [*[c for c in batch.schema.names if c != "text"], "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id", text: str = "text", level: int = LEVEL, margin: float = MARGIN) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` per row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _identify(dictionaries, level, margin), f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def _keep(dictionaries: dict[str, bytes], level: int, margin: float):
    key = _key(dictionaries, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = worker_state(key, lambda: Identifier(dictionaries, level))
        for batch in batches:
            found = [identify(t.as_py()) for t in batch.column("text")]
            stays = [i for i, f in enumerate(found) if f[0] != UNDETERMINED and f[1] >= margin]
            yield batch.take(pa.array(stays, pa.int64()))
        batch = found = stays = None
        give_back()

    return run


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], level: int = LEVEL, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is decided, with all their columns."""
    return docs.mapInArrow(_keep(dictionaries, level, margin), docs.schema)
