"""Key statistics and key-range pages over the given tables."""

from functools import reduce

from pyspark.sql import functions as F

from quayline.operators.filters import range_filter
from quayline.operators.paging import (
    key_stats,
    key_stats_frame,
    page_histogram,
    page_predicate,
    plan_pages,
    plan_step,
    predicate_pages,
    row_bytes,
    split_hot_pages,
    with_page,
)
from quayline.operators.weighted import weighted_pages, with_weighted_page
from quayline.session import staged
from quayline.workloads.registry import query

_ORDER_WIDTH = "8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority)"


@query(
    f"""SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, count(*) AS row_count,
               count(*) - count(o_orderkey) AS null_keys, avg({_ORDER_WIDTH}) AS row_bytes FROM orders"""
)
def key_stats_orders(t):
    return key_stats_frame(t["orders"], "o_orderkey")


@query(
    f"""WITH s AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi,
                          ceil(avg({_ORDER_WIDTH}) * count(*) / 65536) AS pages FROM orders),
            p AS (SELECT lo, greatest(1, ceil((hi - lo) / greatest(pages, 1)))::BIGINT AS step FROM s)
        SELECT (o_orderkey - lo) // step AS page, count(*) AS row_count, min(o_orderkey) AS first_key,
               max(o_orderkey) AS last_key FROM orders, p GROUP BY 1"""
)
def key_paged_scan_orders(t):
    orders = t["orders"]
    stats = key_stats(orders, "o_orderkey")
    paged = with_page(orders, "o_orderkey", stats.minimum, plan_step(stats, page_bytes=64 * 1024))
    return paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query(
    """SELECT CAST(floor(l_orderkey / 1000) AS BIGINT) AS page, count(*) AS row_count FROM lineitem GROUP BY 1"""
)
def key_pages_lineitem(t):
    return page_histogram(t["lineitem"], "l_orderkey", 0, 1000)


@query(
    """WITH s AS (SELECT min(l_extendedprice) AS lo FROM lineitem)
       SELECT CAST(floor((l_extendedprice - lo) / 2500.0) AS BIGINT) AS page, count(*) AS row_count
       FROM lineitem, s GROUP BY 1"""
)
def decimal_pages_lineitem(t):
    low = t["lineitem"].agg(F.min("l_extendedprice")).first()[0]
    return page_histogram(t["lineitem"], "l_extendedprice", low, 2500.0)


@query(
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders), s AS (SELECT min(day) AS lo FROM d)
       SELECT date_diff('day', lo, day) // 30 AS page, count(*) AS row_count FROM d, s GROUP BY 1"""
)
def date_pages_orders(t):
    days = t["orders"].select(F.to_date("o_orderdate").alias("day"))
    low = days.agg(F.min("day")).first()[0]
    return page_histogram(days, "day", low, 30)


def _label(pages, key):
    """Which page predicates a row satisfies: the page number and how many matched."""
    hits = [F.expr(page_predicate(p, key)) for p in pages]
    number = F.coalesce(*[F.when(hit, F.lit(i)) for i, hit in enumerate(hits)])
    matched = reduce(lambda a, b: a + b, [F.coalesce(hit.cast("int"), F.lit(0)) for hit in hits])
    return number, matched


@query(
    """WITH k AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS k FROM orders),
            s AS (SELECT min(k) AS lo, max(k) AS hi FROM k), p AS (SELECT lo, ((hi - lo) + 19) // 20 AS step FROM s)
       SELECT CAST(coalesce((k - lo) // step, ((SELECT hi FROM s) - lo) // step + 1) AS INTEGER) AS page,
              count(*) AS row_count, 1 AS matched FROM k, p GROUP BY 1"""
)
def page_predicates_orders(t):
    status = F.col("o_orderstatus")
    keys = t["orders"].select(F.when(status != "P", F.col("o_orderkey")).alias("k"))
    stats = key_stats(keys, "k")
    span = stats.maximum - stats.minimum
    pages = plan_pages(stats, step=-(-span // 20))
    number, matched = _label(pages, "k")
    return keys.groupBy(number.cast("int").alias("page")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(matched).alias("matched")
    )


@query("SELECT l_linenumber, count(*) AS row_count, 1 AS matched FROM lineitem GROUP BY l_linenumber")
def hot_page_split_lineitem(t):
    rows = t["lineitem"].select("l_linenumber", "l_orderkey")
    stats = key_stats(rows, "l_linenumber")
    pages = plan_pages(stats, step=1)
    counts = {r["page"]: r["row_count"] for r in page_histogram(rows, "l_linenumber", stats.minimum, 1).collect()}
    # No page may hold more than a twentieth of the table.
    split = split_hot_pages(pages, lambda i, _: counts.get(i, 0), -(-stats.rows // 20), "l_orderkey")
    number, matched = _label(split, "l_linenumber")
    found = rows.select("l_linenumber", number.alias("page"), matched.alias("matched"))
    per_page = found.groupBy("l_linenumber", "page").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("matched").alias("matched")
    )
    return per_page.groupBy("l_linenumber").agg(
        F.sum("row_count").alias("row_count"), F.max("matched").alias("matched")
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey >= 100 AND l_orderkey < 2000")
def range_filter_lineitem(t):
    return range_filter(t["lineitem"], "l_orderkey", 100, 2000).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """SELECT 0 AS page, p_partkey, p_size FROM part WHERE p_size < 10
       UNION ALL SELECT 1, p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size < 30
       UNION ALL SELECT 2, p_partkey, p_size FROM part WHERE p_size >= 25"""
)
def explicit_predicates_part(t):
    rules = ["p_size < 10", "p_size >= 10 AND p_size < 30", "p_size >= 25"]
    return predicate_pages(t["part"], rules).select("page", "p_partkey", "p_size")


@query("SELECT (l_orderkey - (SELECT min(l_orderkey) FROM lineitem)) // 2 AS page, count(*) AS row_count FROM lineitem GROUP BY 1")
def small_step_pages_lineitem(t):
    # The step given is kept, however many pages it makes; none of them is listed.
    keys = t["lineitem"].select("l_orderkey")
    return page_histogram(keys, "l_orderkey", key_stats(keys, "l_orderkey").minimum, 2)


_SKEWED = "l_orderkey * l_orderkey * l_orderkey"
_LINE_WIDTH = "3 * 8 + 4 + 4 * 8 + strlen(l_returnflag) + strlen(l_linestatus) + 8 + 8"


@query(
    f"""WITH keys AS (SELECT {_SKEWED} AS k, count(*) AS n, sum({_LINE_WIDTH})::BIGINT AS w FROM lineitem GROUP BY 1),
            placed AS (SELECT k, n, w, (sum(w) OVER (ORDER BY k) - w)::BIGINT // {64 * 1024} AS cell FROM keys),
            cells AS (SELECT cell, min(k) AS lower_key, sum(n)::BIGINT AS row_count, sum(w)::BIGINT AS weight FROM placed GROUP BY cell)
        SELECT row_number() OVER (ORDER BY cell) - 1 AS page, lower_key, lead(lower_key) OVER (ORDER BY cell) AS upper_key,
               row_count, weight, row_count AS found, weight < {2 * 64 * 1024} AS within_twice FROM cells"""
)
def weighted_pages_lineitem(t):
    """A key whose values grow by the cube: pages of equal key distance would hold from none to most of the rows.

    Cubes beyond 64 bits make it a decimal key, exact up to 38 digits; a row weighs the same.
    """
    lines = t["lineitem"]
    ends = lines.agg(F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")).first()
    fits = ends["low"] is None or (-(1 << 21) <= ends["low"] and ends["high"] < 1 << 21)
    cube = F.expr(_SKEWED if fits else _SKEWED.replace("l_orderkey", "cast(l_orderkey as decimal(38))"))
    skewed = lines.withColumn("k", cube)
    width = row_bytes(lines.schema) + 8
    pages = staged(t.spark, weighted_pages(skewed, "k", 64 * 1024, width), "pages")
    found = with_weighted_page(skewed.select("k"), "k", pages).groupBy("page").agg(F.count(F.lit(1)).alias("found"))
    within = (F.col("weight") < 2 * 64 * 1024).alias("within_twice")
    named = [F.col("lower").alias("lower_key"), F.col("upper").alias("upper_key"), F.col("rows").alias("row_count")]
    return pages.join(found, "page").select("page", *named, "weight", "found", within)
