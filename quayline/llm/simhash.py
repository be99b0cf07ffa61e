"""SimHash near-duplicates by meeting in the middle.

A fingerprint is the bitwise majority over the XXH64 (seed 42) of a text's word
shingles. Two fingerprints within an even distance ``radius`` share a value
within ``radius / 2`` flips of both, so every distinct fingerprint is sent to
all values in its half-radius ball. Whoever meets at one value is within
``radius`` of each other: each links to the smallest there, and no link between
components is lost. Equal texts collapse to one fingerprint before that, and a
value is reached by at most as many fingerprints as its ball holds (65 for
radius 2), so no group grows with the data.

Null and empty texts have fingerprint zero and link like any other. A null
doc_id counts last: it names a component only if no other id is in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.llm.common import ASCII_LOWER, utf8
from quayline.llm.components import connected_components
from quayline.session import configure, staged

SEED = 42
SHINGLE = 3
RADIUS = 2
SLICE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one UTF-8 text; words are split at ASCII white space."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    return majority(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8", count=n))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; no hashes have none."""
    n = len(hashes)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE):
        bits = np.unpackbits(hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column("text")), dtype=np.uint64, count=batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed 64-bit number."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id bigint, fp bigint")


def links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(u, v)`` that join all distinct ``fp`` within ``radius`` bits into the right components."""
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even: its half-balls then meet exactly within it")
    flips = [sum(1 << b for b in c) for k in range(radius // 2 + 1) for c in combinations(range(64), k)]
    masks = [m - (1 << 64) if m >> 63 else m for m in flips]
    met = values.select("fp", F.explode(F.lit(masks).cast("array<bigint>")).alias("mask"))
    met = met.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    star = met.withColumn("u", F.min("fp").over(W.partitionBy("variant"))).where("u <> fp")
    pairs = star.select("u", F.col("fp").alias("v")).distinct()
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, label)`` for every fingerprint: the label is the smallest linked fingerprint."""
    spark = prints.sparkSession
    distinct = staged(spark, prints.select("fp").distinct(), "distinct")
    linked = connected_components(links(distinct, radius)).withColumnRenamed("node", "fp")
    return staged(spark, distinct.join(linked, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label")), "labelled")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    spark = configure(docs.sparkSession)
    prints = staged(spark, fingerprints(docs, doc_id, text, shingle), "fingerprints")
    labelled = _components(prints, radius)
    # Smallest ids are found per fingerprint first, so that copies meet in no single task.
    first = staged(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(labelled, "fp"), "first")
    smallest = first.groupBy("label").agg(F.min("first").alias("component_id"))
    named = staged(spark, first.join(smallest, "label").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def text_key() -> Column:
    """A hash of the text that tells null from empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())


def row_order() -> list[Column]:
    """What rows of ``doc_id`` and ``text_key`` are chosen by: smallest id, nulls last, then smallest text hash."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_key")]


def rows_chosen(docs: DataFrame, chosen: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are chosen by ``row_order``, each once; ``keys`` has the keys of all rows."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"))
    kept = rows.select("row", *row_order()).join(chosen, ["no_id", "id", "text_key"], "left_semi")
    # Rows that repeat exactly would all stay; there is a key to look for them without their texts.
    repeated = keys.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count()
    if repeated:
        kept = kept.dropDuplicates(["no_id", "id", "text_key"])
    return kept.select("row.*")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: smallest id, nulls last, then smallest text hash."""
    spark = configure(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), utf8("text").alias("bytes"))
    prints = keyed.mapInArrow(_keyed_fingerprints(shingle), "doc_id bigint, text_key bigint, fp bigint")
    prints = staged(spark, prints, "fingerprints")
    labelled = _components(prints, radius)
    order = F.struct(*row_order())
    first = staged(spark, prints.groupBy("fp").agg(F.min(order).alias("first")).join(labelled, "fp"), "first")
    chosen = first.groupBy("label").agg(F.min("first").alias("first")).select("first.*")
    chosen = staged(spark, chosen.distinct(), "chosen")
    return rows_chosen(docs, chosen, prints)


def _keyed_fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column("bytes")), dtype=np.uint64, count=batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(values.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    return run
