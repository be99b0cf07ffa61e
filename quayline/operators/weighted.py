"""Key-range pages of equal weight, whatever the distribution of the key.

Pages of equal key distance hold very different amounts of data where keys are skewed. Here the
rows' widths are summed per key inside the tasks, the sums are added up along the key without
bringing them into one task, and a page ends where its weight reaches the target. A page is
above the target by less than its last key. The pages are a table; how many there are decides
only how rows find theirs: by a search in a list of bounds that travels with the plan while it
is short, by a join on the key beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError
from quayline.operators.columns import column
from quayline.operators.paging import PAGE_BYTES, row_bytes
from quayline.operators.running import running_total
from quayline.session import staged

# Bounds that travel with a plan: numbers, dates or short texts.
LISTED_PAGES = 20_000

_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BooleanType)


def weighted_keys(df: DataFrame, key: str, page_bytes: int = PAGE_BYTES, width: Column | None = None) -> DataFrame:
    """``(key, cell, weight, rows)`` for each value of the key that is not NULL.

    A cell is a stretch of ``page_bytes`` of the running weight. A heavy key spans several, of which
    only the first has a key: cells rise along the key, but not one by one. A row weighs ``width``, by
    default what its types and texts take.
    """
    if page_bytes <= 0:
        raise InvalidParameterError(f"a page must have a positive number of bytes, not {page_bytes}")
    if not isinstance(df.schema[key].dataType, _ORDERED):
        raise InvalidParameterError(f"pages need a key with an order, not {df.schema[key].dataType.simpleString()}")
    width = row_bytes(df.schema) if width is None else width
    weighed = df.where(column(key).isNotNull()).select(column(key).alias("key"), width.alias("width"))
    keys = weighed.groupBy("key").agg(F.sum("width").alias("weight"), F.count(F.lit(1)).alias("rows"))
    placed = running_total(keys, ["key"], "weight")
    step = F.lit(page_bytes).cast("bigint")
    return placed.select("key", F.call_function("div", F.col("before").cast("bigint"), step).alias("cell"), "weight", "rows")


def weighted_pages(df: DataFrame, key: str, page_bytes: int = PAGE_BYTES, width: Column | None = None) -> DataFrame:
    """``(page, lower, upper, rows, weight)``: pages of ``lower <= key < upper`` of about ``page_bytes`` each.

    The last page is open above, NULL keys have a page NULL without bounds. An empty table has no pages.
    """
    width = row_bytes(df.schema) if width is None else width
    cells = weighted_keys(df, key, page_bytes, width).groupBy("cell").agg(
        F.min("key").alias("lower"), F.sum("rows").alias("rows"), F.sum("weight").alias("weight")
    )
    cells = staged(df.sparkSession, cells.withColumn("one", F.lit(1)), "cells")
    numbered = running_total(cells, ["cell"], "one", "page")
    numbered = staged(df.sparkSession, numbered.select(F.col("page").cast("bigint").alias("page"), "lower", "rows", "weight"), "pages")
    following = numbered.select((F.col("page") - 1).alias("page"), F.col("lower").alias("upper"))
    pages = numbered.join(following, "page", "left").select("page", "lower", "upper", "rows", "weight")
    nulls = df.where(column(key).isNull()).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("weight")).where("rows > 0")
    none = F.lit(None).cast(df.schema[key].dataType)
    return pages.unionByName(nulls.select(F.lit(None).cast("bigint").alias("page"), none.alias("lower"), none.alias("upper"), "rows", "weight"))


def with_weighted_page(df: DataFrame, key: str, pages: DataFrame, name: str = "page") -> DataFrame:
    """``df`` with the number of each row's page among ``pages``, NULL for NULL keys.

    Keys below the first page belong to it, as those above the last one to that.
    """
    spark = df.sparkSession
    bounds = staged(spark, pages.where("page > 0").select("page", "lower"), "bounds")
    n = bounds.count()
    if n <= LISTED_PAGES:
        lower = [r["lower"] for r in bounds.orderBy("page").collect()]
        return df.withColumn(name, _place(column(key), lower, df.schema[key].dataType))
    # Each value of the key is placed once, among keys and bounds in one order, and joined back.
    keys = df.where(column(key).isNotNull()).select(column(key).alias("key")).distinct()
    both = keys.join(bounds.withColumnRenamed("lower", "key"), "key", "full")
    both = both.select("key", F.when(F.col("page").isNotNull(), 1).otherwise(0).alias("step"))
    placed = running_total(both, ["key"], "step").select("key", (F.col("before") + F.col("step")).cast("bigint").alias(name))
    placed = placed.withColumnRenamed("key", "__key")
    return df.join(placed, column(key) == F.col("__key"), "left").drop("__key")


def _place(value, bounds: list, kind: T.DataType):
    """How many of the sorted ``bounds`` are not above the value: a binary search in steps of powers of two."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.when(value.isNotNull(), F.lit(0).cast("bigint"))
    listed = F.lit(bounds).cast(T.ArrayType(kind)) if not isinstance(kind, T.DecimalType) else F.array(*[F.lit(b).cast(kind) for b in bounds])
    there = lambda at, step: (at + step <= len(bounds)) & (F.get(listed, at + step - 1) <= value)
    found = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(there(at, step), at + step).otherwise(at))
    return F.when(value.isNotNull(), found.cast("bigint"))
