import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, InvalidPartitionSpecError, MissingFieldError
from quayline.operators.columns import (
    align_to_table,
    choose_page_key,
    dropped_columns,
    project,
    rename,
    resolve_case_insensitive,
    validate_field_map,
)
from quayline.operators.filters import parse_partition_spec, partition_filter, range_filter, text_filter
from quayline.operators.paging import (
    KeyStats,
    Page,
    key_stats,
    page_grid,
    page_histogram,
    page_predicate,
    plan_pages,
    plan_step,
    split_hot_pages,
    with_page,
)


def test_project(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, d int")
    assert project(df, ["d", "b.c"]).columns == ["d", "b.c"]
    assert project(df, []).columns == df.columns
    with pytest.raises(MissingFieldError):
        project(df, ["x"])


def test_field_map(spark):
    assert validate_field_map(["a", "b"], {"a": "x"}) == {"a": "x", "b": "b"}
    for bad in ({"a": "b"}, {"a": "x", "b": "x"}):
        with pytest.raises(InvalidParameterError):
            validate_field_map(["a", "b"], bad)
    with pytest.raises(MissingFieldError):
        validate_field_map(["a"], {"z": "x"})
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename(df, {"a": "b", "b": "a"}).first().asDict() == {"b": 1, "a": 2}


def test_choose_page_key():
    schema = T.StructType.fromDDL("id bigint, d date, price decimal(9,2), s string, f double, ts timestamp")
    for key in ("id", "d", "price", "f"):
        assert choose_page_key(schema, key) == key
        assert choose_page_key(schema, None, key) == key
    for key in ("s", "ts", "none"):
        with pytest.raises(InvalidParameterError):
            choose_page_key(schema, key)
    assert choose_page_key(schema, None, "s") is None and choose_page_key(schema, None, "ts") is None
    with pytest.raises(InvalidParameterError):
        choose_page_key(schema, None, "none")


def test_align(spark):
    df = spark.createDataFrame([(1, "2", True, b"x")], "ID int, Amount string, flag boolean, raw binary")
    target = T.StructType.fromDDL("id bigint, amount decimal(9,2), flag boolean, raw string, absent date")
    assert tuple(align_to_table(df, target).first()) == (1, Decimal("2.00"), True, "x", None)
    assert dropped_columns(df, T.StructType.fromDDL("id int")) == ["Amount", "flag", "raw"]
    with pytest.raises(InvalidParameterError):
        align_to_table(df, T.StructType.fromDDL("id boolean"))
    twice = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "A")
    with pytest.raises(InvalidParameterError):
        resolve_case_insensitive(twice, T.StructType.fromDDL("a int"))


@pytest.mark.parametrize(
    "spec, pairs",
    [
        ("dt=20240520", {"dt": "20240520"}),
        ("a=1,b=2", {"a": "1", "b": "2"}),
        ("a=1/b=2", {"a": "1", "b": "2"}),
        ("dt='020'", {"dt": "020"}),
        ("城市=北京", {"城市": "北京"}),
        ("", {}),
        (None, {}),
    ],
)
def test_partition_spec(spec, pairs):
    assert parse_partition_spec(spec) == pairs


@pytest.mark.parametrize("spec", ["x=1 or 1=1", "dt", "=1", "dt=", "a=1,a=2", "a=1;drop", ","])
def test_bad_partition_spec(spec):
    with pytest.raises(InvalidPartitionSpecError):
        parse_partition_spec(spec)


def test_partition_filter_compares_text(spark):
    df = spark.createDataFrame([("020", 1), ("20", 2)], "dt string, v int")
    assert [r.v for r in partition_filter(df, "DT=020", ["dt"]).collect()] == [1]
    assert partition_filter(df, "dt=020", []).count() == 2
    with pytest.raises(InvalidPartitionSpecError):
        partition_filter(df, "v=1", ["dt"])


def test_filters(spark):
    df = spark.range(10)
    assert [r.id for r in range_filter(df, "id", 2, 4).collect()] == [2, 3]
    assert text_filter(df, "id > 7").count() == 2
    assert text_filter(df, None).count() == 10


def pages_of(df, key, **rule):
    return plan_pages(key_stats(df, key), **rule)


def check_cover(df, key, pages):
    """Every row satisfies exactly one page predicate."""
    hits = [F.coalesce(F.expr(page_predicate(p, key)).cast("int"), F.lit(0)) for p in pages]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    counts = {r[0] for r in df.select(total).distinct().collect()}
    assert counts == {1}


def test_pages_cover_integers_with_nulls(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 7 != 0, F.col("id") - 300).alias("k"))
    pages = pages_of(df, "k", step=64)
    assert sum(p.null_key for p in pages) == 1
    check_cover(df, "k", pages)


def test_pages_cover_dates_decimals_floats(spark):
    base = spark.range(400)
    dates = base.select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("k"))
    check_cover(dates, "k", pages_of(dates, "k", step=30))
    decimals = base.select((F.col("id") * F.lit(Decimal("0.37"))).cast("decimal(12,2)").alias("k"))
    check_cover(decimals, "k", pages_of(decimals, "k", step=Decimal("7.5")))
    floats = base.select((F.col("id") * 0.1).alias("k"))
    check_cover(floats, "k", pages_of(floats, "k", step=0.7))


@settings(max_examples=200, deadline=None)
@given(
    st.integers(-(2**40), 2**40), st.integers(0, 10**6), st.integers(1, 10**5), st.integers(1, 500)
)
def test_integer_pages_are_contiguous(low, span, step, max_pages):
    stats = KeyStats(low, low + span, 10, 0, 8.0)
    if span // step + 1 > max_pages:
        # The step is kept or refused, never changed.
        with pytest.raises(InvalidParameterError):
            plan_pages(stats, step=step, max_pages=max_pages)
        return
    pages = plan_pages(stats, step=step, max_pages=max_pages)
    assert len(pages) == span // step + 1
    assert pages[0].lower is None and pages[-1].upper is None
    assert all(a.upper == b.lower for a, b in zip(pages, pages[1:]))
    assert all(p.upper > low for p in pages[:-1])
    assert len(pages) == 1 or pages[-1].lower <= low + span


def test_step_subtracts_and_survives_zero_minimum():
    stats = KeyStats(0, 14_999, 15_000, 0, 100.0)
    assert plan_step(stats, page_bytes=150_000) == 1500
    assert plan_step(KeyStats(5, 5, 10, 0, 8.0)) == 1
    assert plan_step(KeyStats(None, None, 0, 0, 0.0)) is None


def test_empty_table_has_no_pages(spark):
    assert pages_of(spark.range(0), "id") == []


def test_all_null_key_is_one_page(spark):
    df = spark.range(5).select(F.lit(None).cast("int").alias("k"))
    assert pages_of(df, "k") == [Page(null_key=True)]


def test_given_bounds_are_kept():
    pages = plan_pages(KeyStats(0, 100, 10, 0, 8.0), step="2.5", lower="10", upper="20")
    assert page_predicate(pages[0], "k") == "`k` >= 10 AND `k` < 13"
    assert pages[-1].lower <= 20 < pages[-1].upper
    with pytest.raises(InvalidParameterError):
        plan_pages(KeyStats(0, 100, 10, 0, 8.0), step=0)


def test_predicate_text():
    assert page_predicate(Page(dt.date(2024, 1, 1), dt.date(2024, 2, 1)), "d") == (
        "`d` >= DATE '2024-01-01' AND `d` < DATE '2024-02-01'"
    )
    assert page_predicate(Page(), "k") == "`k` IS NOT NULL"
    assert page_predicate(Page(null_key=True), "a`b") == "`a``b` IS NULL"


def test_hot_key_is_split(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("k"), "id")
    stats = key_stats(df, "k")
    pages = plan_pages(stats, step=100)
    counts = {r.page: r.row_count for r in page_histogram(df, "k", stats.minimum, 100).collect()}
    split = split_hot_pages(pages, lambda i, _: counts.get(i, 0), 100, "id")
    assert len(split) > len(pages)
    check_cover(df, "k", split)
    assert max(df.where(F.expr(page_predicate(p, "k"))).count() for p in split) < 200


def test_split_keeps_rows_with_null_split_value(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("s"))
    split = split_hot_pages(plan_pages(key_stats(df, "k")), lambda i, _: 300, 50, "s")
    assert len(split) == 6
    check_cover(df, "k", split)


def test_page_grid_matches_histogram():
    pages = plan_pages(KeyStats(10, 99, 10, 2, 8.0), step=20)
    assert page_grid(pages) == (10, 20)
    dates = plan_pages(KeyStats(dt.date(2024, 1, 1), dt.date(2024, 3, 1), 10, 0, 8.0), step=10)
    assert page_grid(dates) == (dt.date(2024, 1, 1), 10)


def test_page_number_is_exact_for_large_keys(spark):
    top = 2**62 + 12345
    df = spark.createDataFrame([(top,), (-5,), (None,)], "k bigint")
    found = [r.page for r in with_page(df, "k", 0, 7).collect()]
    assert found == [top // 7, -5 // 7, None]
