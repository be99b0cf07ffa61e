"""Pages of equal weight against a plain walk along the sorted keys."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.operators import weighted
from quayline.operators.weighted import weighted_pages, with_weighted_page


def plain_pages(rows, target):
    """``{page: (lower, rows, weight)}`` of ``(key, width)`` rows."""
    sums = {}
    for k, w in rows:
        n, total = sums.get(k, (0, 0))
        sums[k] = (n + 1, total + w)
    pages, before, last = [], 0, None
    for k in sorted(sums):
        n, w = sums[k]
        if last != before // target:
            last = before // target
            pages.append([k, 0, 0])
        pages[-1][1] += n
        pages[-1][2] += w
        before += w
    return pages


def test_pages_are_even_on_skewed_keys(spark, monkeypatch):
    monkeypatch.setattr("quayline.operators.running.ROWS", 100)
    rng = random.Random(3)
    # Keys grow by powers, one holds a third of the rows, texts differ in length.
    rows = [(7**6 if i % 3 == 0 else rng.randint(0, 40) ** 6, "t" * rng.randint(0, 30)) for i in range(3000)] + [(None, "abc")] * 5
    df = spark.createDataFrame(rows, "k bigint, t string").repartition(5)
    for target in (400, 3000, 10**9):
        got = {r.page: r for r in weighted_pages(df, "k", target).collect()}
        want = plain_pages([(k, 8 + len(t)) for k, t in rows if k is not None], target)
        assert [(got[i].lower, got[i].rows, got[i].weight) for i in range(len(want))] == [tuple(p) for p in want]
        assert [got[i].upper for i in range(len(want))] == [p[0] for p in want[1:]] + [None]
        assert (got[None].rows, got[None].weight, got[None].lower) == (5, 55, None) and len(got) == len(want) + 1
        heaviest = max(sum(8 + len(t) for k, t in rows if k == key) for key in {k for k, _ in rows if k is not None and k != 7**6})
        # Without the repeated key no page is above the target by more than a key.
        assert all(p[2] < target + heaviest for p in want if p[0] != 7**6 and not p[0] <= 7**6 < (got[want.index(p)].upper or 10**18))


@pytest.mark.parametrize("listed", [20_000, 0])
def test_rows_find_their_page(spark, monkeypatch, listed):
    monkeypatch.setattr(weighted, "LISTED_PAGES", listed)
    day, at = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)
    keys = {
        "bigint": [i**4 for i in range(60)], "double": [i / 7 for i in range(60)], "string": [f"k{i:03}" for i in range(60)],
        "date": [day + dt.timedelta(days=i * i) for i in range(60)], "decimal(12,2)": [Decimal(i) / 4 for i in range(60)],
        "timestamp_ntz": [at + dt.timedelta(hours=i) for i in range(60)],
    }
    for kind, values in keys.items():
        df = spark.createDataFrame([(v, "x" * (i % 9)) for i, v in enumerate(values)] + [(None, "n")], f"k {kind}, t string")
        pages = weighted_pages(df, "k", 100)
        found = with_weighted_page(df, "k", pages).groupBy("page").agg(F.count(F.lit(1)).alias("rows"), F.min("k").alias("low")).collect()
        assert {r.page: (r.rows, r.low) for r in found} == {r.page: (r.rows, r.lower) for r in pages.collect()} and len(found) > 4, kind
    beyond = spark.createDataFrame([(Decimal(-5),), (Decimal(999),)], "k decimal(12,2)")
    whole = weighted_pages(spark.createDataFrame([(Decimal(i),) for i in range(50)], "k decimal(12,2)"), "k", 64)
    last = whole.agg(F.max("page")).first()[0]
    assert [r.page for r in with_weighted_page(beyond, "k", whole).orderBy("k").collect()] == [0, last]


def test_small_tables_and_refusals(spark):
    df = spark.createDataFrame([(1, [1])], "k int, a array<int>")
    assert [tuple(r)[:4] for r in weighted_pages(df, "k", 5).collect()] == [(0, 1, None, 1)]
    assert weighted_pages(df.where("false"), "k").count() == 0
    assert [r.page for r in with_weighted_page(df, "k", weighted_pages(df, "k")).collect()] == [0]
    only_null = df.withColumn("k", F.lit(None).cast("int"))
    assert [(r.page, r.rows) for r in weighted_pages(only_null, "k").collect()] == [(None, 1)]
    for key, size in (("a", 5), ("k", 0)):
        with pytest.raises(InvalidParameterError):
            weighted_pages(df, key, size)


def test_cubes_beyond_64_bits(spark, tmp_path):
    from quayline.workloads import QUERIES

    columns = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    for top, kind in ((2_097_151, "bigint"), (9_000_000, "decimal(38,0)")):
        # Two thousand rows of 98 bytes are three pages of 64 KiB, and a key comes twice or not at all.
        keys = [None, *(top - 7 * (i // 2) for i in range(2000))]
        rows = [(k, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(1995, 1, 2)) for k in keys]
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{top}/lineitem.parquet")
        out = QUERIES["weighted_pages_lineitem"](spark, f"{tmp_path}/{top}")
        assert out.schema["lower_key"].dataType.simpleString() == out.schema["upper_key"].dataType.simpleString() == kind
        want = plain_pages([(k**3, 3 * 8 + 4 + 4 * 8 + 2 + 8 + 8) for k in keys if k], 64 * 1024)
        got = out.orderBy("page").collect()
        assert [(r.lower_key, r.row_count, r.weight, r.found) for r in got] == [(k, n, w, n) for k, n, w in want]
        assert [r.upper_key for r in got] == [p[0] for p in want[1:]] + [None] and len(got) == 3
