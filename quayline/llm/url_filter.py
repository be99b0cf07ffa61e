"""URL rules and a blocked Bloom filter in front of an exact list lookup.

A rule ``(action, host, path)`` fits its host, all subdomains and every path
starting with its own; the longest fitting rule decides. URLs without a rule
are blocked if their canonical form is listed. The list is folded into a
blocked Bloom filter: one 256-bit block per key, eight bits set in it. Only
URLs whose bits are all set go on to the exact hash join, which removes the
filter's false positives; everything is a built-in expression.

Null URLs and URLs without ``://`` have an empty host and path, fit no rule and
are never listed. Repeated URLs are judged row by row; null and repeated list
entries count once. An empty list blocks nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.session import configure

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
WORDS = 4
KEYS_PER_BLOCK = 16
# Blocks up to this size in total are copied to every executor; a larger filter is joined on the block number.
BROADCAST_BYTES = 64 * 1024 * 1024
# Query parameters that never change a page; plain fixed values.
TRACKING = r"(?i)(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``/``m.``, path without ``.html`` and closing slash, query without tracking; else null."""
    bare = F.regexp_replace(host(url), r"^(www|m)\.", "")
    short = F.regexp_replace(F.regexp_replace(path(url), r"\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    return F.when(
        bare != "", F.concat(bare, short, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    )


def rule_struct(rules: list[tuple[str, str, str]], h: Column, p: Column) -> Column:
    """``(action, rule)`` of the longest fitting rule, null if none fits; equal lengths: the first given."""
    found = F.lit(None).cast("struct<action:string,rule:string>")
    for action, name, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((h == name) | h.endswith("." + name)) & p.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(name + prefix).alias("rule"))).otherwise(found)
    return found


def _block_and_bits(key: Column, blocks: int) -> list[Column]:
    """The key's block number and its eight bits, two in each of four words."""
    place = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")
    bits = F.xxhash64(key, F.lit(1))
    words = []
    for w in range(WORDS):
        one, two = (F.shiftrightunsigned(bits, 12 * w + s).bitwiseAND(F.lit(63)).cast("int") for s in (0, 6))
        words.append(_bit(one).bitwiseOR(_bit(two)).alias(f"bits{w}"))
    return [place, *words]


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n)


def blocked_bloom(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """One row per used block with its four words, and the number of blocks."""
    listed = keys.where(F.col(key).isNotNull()).select(key).distinct()
    blocks = max(1, math.ceil(listed.count() / KEYS_PER_BLOCK))
    words = [F.bit_or(f"bits{w}").alias(f"word{w}") for w in range(WORDS)]
    return listed.select(*_block_and_bits(F.col(key), blocks)).groupBy("block").agg(*words), blocks


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", listed_url: str = "url"
) -> DataFrame:
    """All columns of ``pages`` in a struct ``row``, with host, path, rule and verdict."""
    configure(pages.sparkSession)
    names = listed.select(canonical(F.col(listed_url)).alias("key")).where("key is not null").distinct()
    bloom, blocks = blocked_bloom(names, "key")
    if blocks * 8 * (WORDS + 1) <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    u = F.col(url).cast("string")
    parts = pages.select(F.struct("*").alias("row"), host(u).alias("host"), path(u).alias("path"), canonical(u).alias("key"))
    judged = parts.withColumn("hit", rule_struct(rules, F.col("host"), F.col("path")))
    result = ["row", "host", "path", F.col("hit.rule").alias("rule")]
    # A rule decides, or there is no key to look up.
    decided = judged.where(F.col("hit").isNotNull() | F.col("key").isNull()).select(
        *result, F.coalesce("hit.action", F.lit("allow")).alias("verdict")
    )
    open_ = judged.where(F.col("hit").isNull() & F.col("key").isNotNull())
    probe = open_.select("*", *_block_and_bits(F.col("key"), blocks)).join(bloom, "block", "left")
    passes = F.lit(True)
    for w in range(WORDS):
        passes = passes & (F.col(f"word{w}").bitwiseAND(F.col(f"bits{w}")) == F.col(f"bits{w}"))
    probe = probe.withColumn("maybe", F.coalesce(passes, F.lit(False)))
    free = probe.where(~F.col("maybe")).select(*result, F.lit("allow").alias("verdict"))
    sure = probe.where("maybe").join(names.withColumn("listed", F.lit(True)), "key", "left")
    exact = sure.select(*result, F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))
    return decided.unionByName(free).unionByName(exact)
