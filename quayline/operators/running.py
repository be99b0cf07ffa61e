"""Running totals over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.session import staged

# Rows of a task, and so of a window; totals of tasks are one row each.
ROWS = 250_000


def running_total(df: DataFrame, order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with column ``name``: the sum of ``value`` over all rows that come before in ``order``.

    Rows are dealt into ranges of the order; each range is summed up inside one task, and
    what lies before a range follows from the ranges' totals. ``order`` has to be unique.
    """
    spark = df.sparkSession
    tasks = max(1, -(-df.count() // ROWS))
    dealt = df.repartitionByRange(tasks, *order).withColumn("__range", F.spark_partition_id())
    dealt = staged(spark, dealt, "dealt")
    ends = dealt.groupBy("__range").agg(F.sum(value).alias("__sum"))
    earlier = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    bases = ends.select("__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"))
    inside = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    total = F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return dealt.join(F.broadcast(bases), "__range").withColumn(name, total).drop("__range", "__base")
