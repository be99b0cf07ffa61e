"""Cost-sized key-range pages.

A table is measured once (min, max, row count, NULL keys, row width) and cut
into half-open key ranges of about ``page_bytes`` each. The same pages serve
as JDBC predicates, one Spark partition per page, and as a page number column
on any DataFrame.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError
from quayline.functions.literal import quote_ident
from quayline.operators.columns import column

# Target size of a page and rows sampled for the row width.
PAGE_BYTES = 100 * 1024 * 1024
SAMPLE_ROWS = 100

# A page is a Spark task and a line of the plan: a step that asks for more of them is refused.
MAX_PAGES = 10_000_000

_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class KeyStats:
    """One aggregated row about a table and its page key."""

    minimum: object
    maximum: object
    rows: int
    null_keys: int
    row_bytes: float


@dataclass(frozen=True)
class Page:
    """``lower <= key < upper``, or the NULL keys; optionally one residue of a split."""

    lower: object = None
    upper: object = None
    null_key: bool = False
    split: tuple[str, int, int] | None = None


def row_bytes(schema: T.StructType) -> Column:
    """Width of one row: fixed by type, measured for text, bytes and nested values."""
    fixed, measured = 0, []
    for f in schema:
        kind = f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            measured.append(F.coalesce(F.octet_length(column(f.name)), F.lit(0)))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            measured.append(F.coalesce(F.octet_length(F.to_json(column(f.name))), F.lit(0)))
        elif isinstance(kind, (T.ByteType, T.BooleanType)):
            fixed += 1
        elif isinstance(kind, T.ShortType):
            fixed += 2
        elif isinstance(kind, (T.IntegerType, T.FloatType, T.DateType)):
            fixed += 4
        elif isinstance(kind, T.DecimalType):
            fixed += 16
        else:
            fixed += 8
    total = F.lit(fixed).cast("bigint")
    for width in measured:
        total = total + width
    return total


def key_stats_frame(df: DataFrame, key: str) -> DataFrame:
    """MIN, MAX, COUNT and NULL count of a key plus the mean row width, in one pass."""
    return df.agg(
        F.min(column(key)).alias("min_key"),
        F.max(column(key)).alias("max_key"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(column(key).isNull()).alias("null_keys"),
        F.avg(row_bytes(df.schema)).alias("row_bytes"),
    )


def sampled_row_bytes(df: DataFrame, rows: int = SAMPLE_ROWS) -> float:
    """Mean width of the first ``rows`` rows; only the widths reach the driver."""
    widths = [r[0] for r in df.select(row_bytes(df.schema).alias("w")).limit(rows).collect()]
    return sum(widths) / len(widths) if widths else 0.0


def key_stats(df: DataFrame, key: str, sample_rows: int | None = None) -> KeyStats:
    """Measure a table; with ``sample_rows`` the row width comes from a sample."""
    if sample_rows is None:
        r = key_stats_frame(df, key).first()
        width = r["row_bytes"] or 0.0
    else:
        r = key_stats_frame(df.select(column(key)), key).first()
        width = sampled_row_bytes(df, sample_rows)
    return KeyStats(r["min_key"], r["max_key"], r["row_count"], r["null_keys"], float(width))


def _number(value):
    """A key as a number: dates count in epoch days, decimals stay exact."""
    if isinstance(value, dt.datetime):
        raise InvalidParameterError("page on a number or a date, not on a timestamp")
    if isinstance(value, dt.date):
        return (value - _EPOCH).days
    if isinstance(value, str):
        try:
            return int(value)
        except ValueError:
            try:
                return (dt.date.fromisoformat(value) - _EPOCH).days
            except ValueError:
                return Decimal(value)
    return value


def plan_step(stats: KeyStats, page_bytes: int = PAGE_BYTES):
    """Key distance per page: (max - min) / pages, whole for integer and date keys."""
    if stats.rows == 0 or stats.minimum is None:
        return None
    low, high = _number(stats.minimum), _number(stats.maximum)
    if high == low:
        return 1
    pages = max(1, math.ceil(stats.row_bytes * stats.rows / page_bytes))
    span = high - low
    if isinstance(low, int) and isinstance(high, int):
        return max(1, -(-span // pages))
    return span / pages


def plan_pages(stats: KeyStats, step=None, lower=None, upper=None, max_pages: int = MAX_PAGES) -> list[Page]:
    """All pages of a table, of exactly the step given.

    The outer bounds are open unless given, so no row is missed.
    """
    if stats.rows == 0:
        return []
    pages: list[Page] = []
    low = stats.minimum if lower is None else lower
    high = stats.maximum if upper is None else upper
    if low is not None and high is not None:
        is_date = isinstance(low, dt.date)
        low, high = _number(low), _number(high)
        width = plan_step(stats) if step is None else _number(step)
        if width is None or width <= 0:
            raise InvalidParameterError(f"page step must be positive, not {width!r}")
        if isinstance(low, int) and isinstance(high, int):
            width = math.ceil(width)
            count = (high - low) // width + 1
        else:
            low, width = type(low)(low), type(low)(width)
            count = int((high - low) / width) + 1 if high >= low else 0
            while count and low + count * width <= high:
                count += 1
        if count > max_pages:
            raise InvalidParameterError(f"step {step} makes {count} pages; {max_pages} is the most")

        def bound(i):
            at = low + i * width
            return _EPOCH + dt.timedelta(days=at) if is_date else at

        pages = [Page(bound(i), bound(i + 1)) for i in range(max(count, 0))]
        if pages and lower is None:
            pages[0] = replace(pages[0], lower=None)
        if pages and upper is None:
            pages[-1] = replace(pages[-1], upper=None)
    if stats.null_keys:
        pages.append(Page(null_key=True))
    return pages


def page_grid(pages: list[Page]):
    """Start and width of an equal-width plan of at least two key ranges."""
    ranges = [p for p in pages if not p.null_key]
    first = ranges[0].upper
    step = ranges[1].lower if ranges[1].upper is None else ranges[1].upper
    if len(ranges) == 2 and ranges[1].upper is None:
        # Only one inner edge: any width that keeps both sides apart will do.
        step = 1
    else:
        step = step - first
    days = isinstance(first, dt.date)
    width = step.days if isinstance(step, dt.timedelta) else step
    return (first - dt.timedelta(days=width) if days else first - width), width


def _literal(value) -> str:
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return repr(value) if isinstance(value, float) else str(value)


def page_predicate(page: Page, key: str) -> str:
    """A page as SQL text, the same in MySQL and in Spark."""
    name = quote_ident(key)
    if page.null_key:
        parts = [f"{name} IS NULL"]
    else:
        parts = []
        if page.lower is not None:
            parts.append(f"{name} >= {_literal(page.lower)}")
        if page.upper is not None:
            parts.append(f"{name} < {_literal(page.upper)}")
        if not parts:
            parts.append(f"{name} IS NOT NULL")
    if page.split is not None:
        by, n, residue = page.split
        hashed = f"MOD(CRC32(CONCAT({quote_ident(by)}, '')), {n})"
        if residue == 0:
            parts.append(f"({hashed} = 0 OR {quote_ident(by)} IS NULL)")
        else:
            parts.append(f"{hashed} = {residue}")
    return " AND ".join(parts)


def predicate_pages(df: DataFrame, predicates, name: str = "page") -> DataFrame:
    """Pages given as SQL conditions, in one scan: a row appears once per condition it meets."""
    hits = F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
    return df.select(F.explode(F.array_compact(hits)).alias(name), "*")


def split_hot_pages(pages: list[Page], rows_of, max_rows: int, split_by: str) -> list[Page]:
    """Cut pages with too many rows by a hash of ``split_by``, whatever the key repeats."""
    out: list[Page] = []
    for i, page in enumerate(pages):
        n = -(-rows_of(i, page) // max_rows)
        if n <= 1:
            out.append(page)
        else:
            out.extend(replace(page, split=(split_by, n, r)) for r in range(n))
    return out


def with_page(df: DataFrame, key: str, lower, step, name: str = "page") -> DataFrame:
    """Add the page number ``floor((key - lower) / step)``; NULL keys get page NULL."""
    kind = df.schema[key].dataType
    low, width = _number(lower), _number(step)
    value = F.unix_date(column(key)).cast("bigint") if isinstance(kind, T.DateType) else column(key)
    if isinstance(kind, (T.IntegralType, T.DateType)):
        width = math.ceil(width)
        offset = value.cast("bigint") - F.lit(low).cast("bigint")
        page = _floor_div(offset, width)
    else:
        page = F.floor((value - F.lit(low)) / F.lit(width))
    return df.withColumn(name, page.cast("bigint"))


def _floor_div(value: Column, divisor: int) -> Column:
    """Whole-number floor division, exact beyond the 53 bits of a double."""
    d = F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, d), d)


def page_histogram(df: DataFrame, key: str, lower, step) -> DataFrame:
    """Rows per page: one partial aggregation, at most one row per page."""
    return with_page(df.select(column(key)), key, lower, step).groupBy("page").agg(
        F.count(F.lit(1)).alias("row_count")
    )
