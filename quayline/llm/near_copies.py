"""Near copies by exact Jaccard similarity of word shingles.

Two texts are near copies if their sets of five-word shingles agree to 0.8 or
more, and linked near copies form groups. The join finds every such pair: all
shingles have one order, and sets as similar as that share one of the first
``n - ceil(0.8 n) + 1`` shingles of each. Sets that share one are candidates;
those whose sizes or sketches rule it out go, and the others are compared shingle
by shingle. The order puts shingles last that
are common in a sample; it decides how many candidates there are, not which
pairs are found.

Equal sets collapse first. Then SimHash links sets: fingerprints within two bits meet in their half-radius
balls, and what meets there is compared exactly. Most sets as similar as wanted differ in more bits, so the
prefix join finds the rest: all sets at a shingle that SimHash has not linked are compared with two
there, the smallest and the one that has most of its shingles still to come, which in a group of edited copies
is the original or what is closest to it. Only those of different groups are compared with each other then, so a large
group of near copies costs two comparisons a member and shingle. Pairs are made only
where sizes and the places of the common shingle leave room for the similarity: texts
that share a passage, but less than they would have to, meet at places too far back.
Members of such a group that are similar to none of the two stay pairs of their own, each with all others.

Shingles count as their 64-bit XXH64, sets as their 128-bit XXH3. Null and empty
texts have the empty set and are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.llm import simhash
from quayline.llm.common import ASCII_LOWER, discard, give_back, shuffles_cleaned, small_batches, utf8, worker_state
from quayline.llm.components import connected_components
from quayline.llm.simhash import SEED, majority, row_order, rows_chosen, text_key
from quayline.session import configure, staged

SHINGLE = 5
#: Similarity of at least 4 / 5.
PART, WHOLE = 4, 5
# Documents sampled for common shingles: so many at least, and one of so many. What a fixed number sees of a passage shrinks
# as the table grows, and sets would meet at passages of the larger tables alone.
SAMPLE, EVERY = 4_000, 12
# The most common shingles that travel with the tasks, 12 bytes each.
COMMON = 1 << 20
# The fewest bits of a set's sketch, a power of two.
BITS = 1024
# 64-bit words of a smaller sketch, which pairs are made by.
FOLDED = 4
# Keys of rows to compare that travel with the tasks; more are joined.
TRAVEL = 1 << 20


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of one UTF-8 text, sorted; words are split at ASCII white space."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    grams = {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=len(grams)))


def prefix(found: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles one of which any set that is similar enough has among its own."""
    n = len(found)
    if not n:
        return found
    often = np.zeros(n, dtype=np.int64)
    if len(common):
        slot = np.minimum(np.searchsorted(common, found), len(common) - 1)
        often = np.where(common[slot] == found, counts[slot], 0)
    return found[np.lexsort((found, often))[: n + (-PART * n // WHOLE) + 1]]


def sketch(found: np.ndarray) -> bytes:
    """Parities of the shingles by their lowest bits: two sketches differ in no more bits than the sets in shingles.

    There are at least as many bits as shingles, a power of two: with fewer, the sketches of any two large sets are as like as not.
    """
    bits = max(BITS, 1 << max(0, len(found) - 1).bit_length())
    return np.packbits((np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ, the longer one taken as parities of parities."""
    a, b = sorted((np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum(dtype=np.int64))


def folded(sketch_: bytes) -> np.ndarray:
    """The sketch in ``FOLDED`` words: parities of parities."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch_, dtype="<i8").reshape(-1, FOLDED), axis=0)


def _sets(common: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near_copies", lambda: True)  # what another operator has left in the worker goes
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column("bytes")]
            sketches = [sketch(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(sketches, pa.binary()),
                    pa.array([folded(s) for s in sketches], pa.list_(pa.int64())),
                    pa.array(np.array([majority(s) for s in sets], dtype=np.uint64).view(np.int64)),
                    pa.array([prefix(s, common, counts).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "digest", "n", "sketch", "folded", "fp", "prefix"],
            )
        batch = sets = sketches = None
        give_back()

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column("bytes")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "hashes"])


def _mixed(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One number for an id and a text: rows that have another one are other rows."""
    return ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ keys.astype(np.int64).view(np.uint64)


def _hashes_among(wanted: np.ndarray):
    """Hashes of the texts of rows that may be among the wanted ones, given by their sorted mixed keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mixed = _mixed(batch.column("doc_id").fill_null(0).to_numpy(), batch.column("text_key").to_numpy())
            slot = np.minimum(np.searchsorted(wanted, mixed), max(0, len(wanted) - 1))
            batch = batch.filter(pa.array(wanted[slot] == mixed if len(wanted) else np.zeros(len(mixed), dtype=bool)))
            sets = [shingles(t.as_py()).tobytes() for t in batch.column("bytes")]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "hashes"])
        batch = sets = columns = None
        give_back()

    return run


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and sketches do not rule it out that they are similar enough."""
    for batch in batches:
        n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
        fit = WHOLE * np.minimum(n, m) >= PART * np.maximum(n, m)
        at = np.flatnonzero(fit)
        a, b = (batch.column(c).take(pa.array(at)).to_pylist() for c in ("a", "b"))
        differ = np.fromiter(map(differing, a, b), dtype=np.int64, count=len(at))
        fit[at] = (WHOLE + PART) * differ <= (WHOLE - PART) * (n + m)[at]
        yield batch.select(["u", "v"]).filter(pa.array(fit))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column("bytes")]
        whole = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)])
        yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64))], ["token"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"))):
            a, b = (np.frombuffer(x.as_py(), dtype=np.uint64) for x in (a, b))
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if WHOLE * shared >= PART * (len(a) + len(b) - shared):
                keep.append(i)
        yield batch.select(["u", "v"]).take(pa.array(keep, pa.int64()))


def _common(keyed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sampled documents have, sorted, and how many have them."""
    total = keyed.count()
    part = min(max(1, total // SAMPLE), EVERY)
    some = keyed.where(F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(part)) == 0).select("bytes")
    counted = some.mapInArrow(_each, "token bigint").groupBy("token").count().where("count > 1")
    counted = staged(keyed.sparkSession, counted.select("token", F.col("count").cast("int").alias("count")), "counted")
    # From the smallest count on from which they can travel: no more than that leave the executors.
    tokens, least = 0, None
    for r in counted.groupBy("count").agg(F.count("*").alias("tokens")).orderBy(F.desc("count")).collect():
        if (tokens := tokens + r["tokens"]) > COMMON:
            break
        least = r["count"]
    rows = counted.where(F.col("count") >= least if least else F.lit(False)).toArrow()
    discard(counted)
    tokens = rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows.column("count").to_numpy()[order]


def _verified(pairs: DataFrame, keyed: DataFrame, first: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` of sets that are similar enough."""
    spark = pairs.sparkSession
    one = first.select(F.col("node").alias("u"), "n", F.col("sketch").alias("a"))
    other = first.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("sketch").alias("b"))
    pairs = pairs.join(other, "v").join(one, "u").select("u", "v", "n", "m", "a", "b").mapInArrow(_possible, "u bigint, v bigint")
    pairs = staged(spark, pairs, "possible")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    wanted = staged(spark, nodes.join(first, "node").select("node", "first.*"), "wanted")
    # One Python function in a stage: each more would keep another worker on every core, also for the stages to come.
    if wanted.count() <= TRAVEL:
        # So few keys travel with the tasks, and only the hashes of the texts they name are shuffled.
        rows = wanted.select("id", "text_key").toPandas()
        keys = np.unique(_mixed(rows["id"].to_numpy(), rows["text_key"].to_numpy()))
        sets = keyed.mapInArrow(_hashes_among(keys), "doc_id bigint, text_key bigint, hashes binary").select(*row_order(), "hashes")
        sets = sets.join(wanted, ["no_id", "id", "text_key"]).select("node", "hashes")
    else:
        texts = keyed.select(*row_order(), "bytes").join(wanted, ["no_id", "id", "text_key"])
        sets = texts.select("node", "bytes").mapInArrow(_hashes, "node bigint, hashes binary")
    # Rows that repeat exactly have one set.
    sets = sets.dropDuplicates(["node"])
    sets = staged(spark, sets, "sets")
    both = pairs.join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
    both = both.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u")
    similar = staged(spark, both.select("u", "v", "a", "b").mapInArrow(_similar, "u bigint, v bigint"), "similar")
    discard(pairs, wanted, sets)
    return similar


def _within_reach(n: str, at: str, m: str, to: str) -> Column:
    """Whether sets of ``n`` and ``m`` shingles whose first common one has these places can be similar enough.

    What they share lies from there on, and has to be 4 / 9 of the two together at least.
    """
    n, at, m, to = (F.col(c).cast("bigint") for c in (n, at, m, to))
    need = PART * (n + m)
    return (need <= (PART + WHOLE) * (n - at)) & (need <= (PART + WHOLE) * (m - to)) & (WHOLE * F.least(n, m) >= PART * F.greatest(n, m))


def _linked_by_prints(first: DataFrame, keyed: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of similar sets among those whose SimHash fingerprints link."""
    spark = first.sparkSession
    least = staged(spark, first.groupBy("fp").agg(F.min("node").alias("least")), "prints")
    same = first.join(least, "fp").where("node <> least").select(F.col("least").alias("u"), F.col("node").alias("v"))
    of_u, of_v = (least.select(F.col("fp").alias(c), F.col("least").alias(f"least_{c}")) for c in ("u", "v"))
    near = simhash.links(least.select("fp")).join(of_u, "u").join(of_v, "v")
    near = near.select(F.least("least_u", "least_v").alias("u"), F.greatest("least_u", "least_v").alias("v"))
    linked = staged(spark, same.union(near).distinct(), "linked")
    similar = _verified(linked, keyed, first)
    discard(least, linked)
    return similar


def _size_and_place() -> list[Column]:
    return [F.shiftright("place", 32).cast("int").alias("n"), F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("at")]


def _centres(met: DataFrame) -> DataFrame:
    """``(token, centres)``: the sets at a shingle that all others there are compared with.

    One is the set that has most of its shingles still to come: an original whose copies are edited has no rare shingles of its own
    before, so it is closer to each copy than copies are to each other. The other is the smallest.
    """
    rows = met.select("token", "node", *_size_and_place())
    by_place, by_node = (F.min(F.struct(*order)) for order in (("at", "node", "n"), ("node", "at", "n")))
    both = rows.groupBy("token").agg(by_place.alias("a"), by_node.alias("b"))
    return both.select("token", F.array(*(F.struct(f"{c}.node", f"{c}.n", f"{c}.at") for c in "ab")).alias("centres"))


def _pairs(met: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of different labels that sizes, places and small sketches leave room for, the smaller set first.

    Sets whose shingles before this one are the same have met there already: what they share comes once for each place where it is
    interrupted, not once for each shingle.
    """
    # Of sets that are similar enough the larger is of the smaller one's size class or of the next; a little wider than need be.
    size = F.floor(F.log(1.01 * WHOLE / PART, F.col("n"))).cast("int")
    one = met.select("token", F.col("node").alias("u"), "n", "at", "label", F.col("folded").alias("a"), F.col("before").alias("p"), F.explode(F.array(size, size + 1)).alias("size"))
    other = met.select("token", F.col("node").alias("v"), F.col("n").alias("m"), F.col("at").alias("to"), F.col("label").alias("l"), F.col("folded").alias("b"), F.col("before").alias("q"), size.alias("size"))
    differ = sum(F.bit_count(F.col("a")[i].bitwiseXOR(F.col("b")[i])) for i in range(FOLDED))
    alike = (WHOLE + PART) * differ <= (WHOLE - PART) * (F.col("n") + F.col("m"))
    new = F.expr("(n < m or n = m and u < v) and label <> l and (p is null or q is null or p <> q)")
    return one.join(other, ["token", "size"]).where(new & _within_reach("n", "at", "m", "to") & alike).select("u", "v")


def _links(first: DataFrame, keyed: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of similar sets that join all of them into the right groups."""
    spark = first.sparkSession
    by_print = _linked_by_prints(first, keyed)
    known = connected_components(by_print)
    # Size and place in one number: these are by far the most rows of all.
    place = F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("at")
    met = first.select("node", "n", F.posexplode("prefix").alias("at", "token")).select("token", "node", place.alias("place"))
    # Ends per token are combined inside the tasks, and most tokens, which one set alone has, meet nothing.
    ends = met.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("token")
    met = staged(spark, met.join(ends, "token"), "met")
    stars = met.select("token", "node", *_size_and_place()).join(_centres(met), "token").select("node", "n", "at", F.explode("centres").alias("c"))
    stars = stars.select("node", "n", "at", F.col("c.node").alias("centre"), F.col("c.n").alias("m"), F.col("c.at").alias("to"))
    stars = stars.where((F.col("node") != F.col("centre")) & _within_reach("n", "at", "m", "to"))
    stars = stars.select(F.least("centre", "node").alias("u"), F.greatest("centre", "node").alias("v")).distinct()
    for c in ("u", "v"):
        stars = stars.join(known.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")), c, "left")
    stars = stars.where("coalesce(of_u, u) <> coalesce(of_v, v)").select("u", "v")
    stars = staged(spark, stars, "stars")
    links = by_print.union(_verified(stars, keyed, first))
    # What shares a shingle and is not yet in one group is compared as well.
    groups = connected_components(links)
    ungrouped = met
    met = met.join(groups, "node", "left").select("token", "node", *_size_and_place(), F.coalesce("label", "node").alias("label"))
    met = staged(spark, met, "grouped")
    discard(ungrouped, groups)
    grouped = met
    mixed = met.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    met = met.join(mixed, "token", "left_semi").join(first.select("node", "folded"), "node")
    met = met.withColumn("before", F.lag("token").over(W.partitionBy("node").orderBy("at", "token")))
    met = staged(spark, met, "mixed")
    discard(grouped)
    pairs = _pairs(met)
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    pairs = staged(spark, pairs.join(stars, ["u", "v"], "left_anti"), "pairs")
    discard(met, stars, known)
    return links.union(_verified(pairs, keyed, first))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: smallest id, nulls last, then smallest text hash."""
    spark = configure(docs.sparkSession)
    with small_batches(spark), shuffles_cleaned(spark):
        return _keep_one(spark, docs)


def _keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), utf8("text").alias("bytes"))
    schema = "doc_id bigint, text_key bigint, digest binary, n int, sketch binary, folded array<bigint>, fp bigint, prefix array<bigint>"
    sets = keyed.mapInArrow(_sets(*_common(keyed)), schema)
    alike = [F.first(c).alias(c) for c in ("n", "sketch", "folded", "fp", "prefix")]
    first = sets.groupBy("digest").agg(F.min(F.struct(*row_order())).alias("first"), *alike).drop("digest")
    first = staged(spark, first.withColumn("node", F.monotonically_increasing_id()), "first")
    labels = connected_components(_links(first, keyed))
    grouped = first.select("node", "first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    chosen = staged(spark, grouped.groupBy("label").agg(F.min("first").alias("first")).select("first.*"), "chosen")
    return rows_chosen(docs, chosen, keyed.select("doc_id", "text_key"))
