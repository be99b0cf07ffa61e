"""Database tables over JDBC: pruned, filtered and paged scans.

Pages become Spark partitions, so a table is read in parallel by key range.
Statistics are aggregated in the database; only one row per statistic, or
one row per page, comes back.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import MissingFieldError, MissingParameterError
from quayline.functions.literal import quote_ident, quote_text
from quayline.functions.numeric import rescale_decimal
from quayline.functions.temporal import ntz_to_millis, to_millis
from quayline.operators.columns import choose_page_key, column, project, rename
from quayline.operators.filters import text_filter
from quayline.operators.paging import (
    PAGE_BYTES,
    SAMPLE_ROWS,
    KeyStats,
    Page,
    page_grid,
    page_predicate,
    plan_pages,
    plan_step,
    sampled_row_bytes,
    split_hot_pages,
)
from quayline.refs import PageRule, SourceRef
from quayline.session import configure

# The MySQL driver and its liveness query.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"
PING_QUERY = "SELECT 1 FROM DUAL"
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class JdbcScan:
    """Everything ``spark.read`` is told about one table scan."""

    options: dict[str, str]
    table: str
    predicates: list[str] = field(default_factory=list)


def connection_options(source: SourceRef) -> dict[str, str]:
    """Connection part of the JDBC options."""
    options = {
        "url": source.jdbc_url(),
        "driver": MYSQL_DRIVER,
        # Without a cursor the driver holds a whole page in memory.
        "useCursorFetch": "true",
        "fetchsize": str(FETCH_ROWS),
    }
    if source.user:
        options["user"] = source.user
    if source.password:
        options["password"] = source.password
    return options


def load(spark: SparkSession, scan: JdbcScan) -> DataFrame:
    """Open a scan: one partition per predicate, or a single one without any."""
    if scan.predicates:
        rest = {k: v for k, v in scan.options.items() if k != "url"}
        return spark.read.jdbc(scan.options["url"], scan.table, predicates=scan.predicates, properties=rest)
    return spark.read.format("jdbc").options(**scan.options).option("dbtable", scan.table).load()


def query(spark: SparkSession, options: dict[str, str], sql: str) -> DataFrame:
    """Run one statement in the database."""
    return spark.read.format("jdbc").options(**options).option("query", sql).load()


def stats_sql(table: str, key: str) -> str:
    """MIN, MAX, COUNT and NULL keys of a page key in one statement."""
    k = quote_ident(key)
    return (
        f"SELECT MIN({k}) AS min_key, MAX({k}) AS max_key, COUNT(*) AS row_count, "
        f"COUNT(*) - COUNT({k}) AS null_keys FROM {table}"
    )


def sample_sql(table: str, rows: int = SAMPLE_ROWS) -> str:
    """A few rows of a table; Spark does not send its own limit to the database."""
    return f"SELECT * FROM {table} LIMIT {int(rows)}"


def histogram_sql(table: str, key: str, pages: list[Page]) -> str:
    """Rows per equal-width page, numbered from the first; open ends fall outside 0..n-1."""
    lower, step = page_grid(pages)
    k = quote_ident(key)
    if isinstance(lower, dt.date):
        distance = f"DATEDIFF({k}, '{lower.isoformat()}')"
    else:
        distance = f"({k} - ({lower}))"
    page = f"FLOOR({distance} / {step})"
    return f"SELECT {page} AS page, COUNT(*) AS row_count FROM {table} WHERE {k} IS NOT NULL GROUP BY {page}"


def rows_per_page(counts, pages: list[Page], null_keys: int) -> list[int]:
    """Histogram rows ``(page, row_count)`` laid over the planned pages."""
    ranges = sum(not p.null_key for p in pages)
    rows = [0] * ranges
    for page, count in counts:
        rows[min(max(int(page), 0), ranges - 1)] += int(count)
    return rows + [null_keys] * (len(pages) - ranges)


def measure(spark: SparkSession, options: dict[str, str], table: str, key: str) -> KeyStats:
    """Key statistics by aggregate, row width from a sample that the database itself limits."""
    r = query(spark, options, stats_sql(table, key)).first()
    width = sampled_row_bytes(query(spark, options, sample_sql(table)), SAMPLE_ROWS)
    return KeyStats(r["min_key"], r["max_key"], int(r["row_count"]), int(r["null_keys"]), width)


def pages_for(
    rule: PageRule, stats: KeyStats, page_bytes: int = PAGE_BYTES, splits: int | None = None
) -> list[Page]:
    """Pages of a table under a rule whose gaps the statistics fill.

    ``splits`` asks for that many pages instead of a page size.
    """
    if splits:
        page_bytes = max(1.0, stats.row_bytes * stats.rows / splits)
    step = rule.step if rule.step is not None else plan_step(stats, page_bytes)
    return plan_pages(stats, step, rule.lower, rule.upper)


def read_jdbc(
    spark: SparkSession,
    source: SourceRef,
    table: str,
    columns=None,
    where: str | None = None,
    pages: PageRule | None = None,
    primary_key: str | None = None,
    field_map: dict[str, str] | None = None,
    custom_schema: str | None = None,
    page_bytes: int = PAGE_BYTES,
    split_by: str | None = None,
    max_page_rows: int | None = None,
    extra_options: dict[str, str] | None = None,
    splits: int | None = None,
    max_connections: int | None = None,
    decimals: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Scan a table. Column pruning and ``where`` are pushed into the database.

    ``pages`` or a numeric ``primary_key`` makes the scan parallel; without
    either, the database is asked for the table's primary key. Pages with
    more than ``max_page_rows`` rows, a repeated key say, are cut further by a
    hash of ``split_by``. ``columns``, ``where`` and the page key use view names
    of ``field_map``; predicates, ``split_by`` and ``decimals``, wanted precisions
    and scales, are by raw database names.
    """
    configure(spark)
    options = {**connection_options(source), **(extra_options or {})}
    if custom_schema:
        options["customSchema"] = custom_schema
    name = quote_ident(table)
    predicates = list(pages.predicates) if pages else []
    if not pages and not primary_key:
        primary_key = primary_key_of(index_profile(query(spark, options, index_sql(source.database, table))))
    if not predicates and (pages or primary_key):
        schema = load(spark, JdbcScan(options, name)).schema
        raw_of = {view: raw for raw, view in (field_map or {}).items()}
        rule_key = raw_of.get(pages.key, pages.key) if pages else None
        key = choose_page_key(schema, rule_key, primary_key)
        if key:
            stats = measure(spark, options, name, key)
            planned = pages_for(pages or PageRule(key), stats, page_bytes, splits)
            if max_page_rows and planned:
                planned = _split(spark, options, name, key, planned, stats, split_by, max_page_rows)
            predicates = [page_predicate(p, key) for p in planned]
    rows = load(spark, JdbcScan(options, name, predicates))
    if max_connections and len(predicates) > max_connections:
        # Narrow: a task reads its pages one after the other, and what follows has as many tasks.
        rows = rows.coalesce(max_connections)
    df = rename(as_read(rows, decimals), field_map)
    return project(text_filter(df, where), columns)


def _split(spark, options, table, key, planned, stats, split_by, max_page_rows) -> list[Page]:
    """Cut crowded pages; at most one counted row per page reaches the driver."""
    if not split_by:
        raise MissingParameterError("max_page_rows needs split_by, a column that varies within a page")
    if sum(not p.null_key for p in planned) > 1:
        found = query(spark, options, histogram_sql(table, key, planned)).collect()
        counts = [(r["page"], r["row_count"]) for r in found]
    else:
        counts = [(0, stats.rows - stats.null_keys)] if not planned[0].null_key else []
    rows = rows_per_page(counts, planned, stats.null_keys)
    return split_hot_pages(planned, lambda i, _: rows[i], max_page_rows, split_by)


def as_read(df: DataFrame, decimals: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Values as the reader hands them over.

    Timestamps end at the millisecond; decimals of another scale round up.
    """
    decimals = decimals or {}
    unknown = [n for n in decimals if n not in df.columns]
    if unknown:
        raise MissingFieldError(f"no such column: {', '.join(unknown)}")
    pick = []
    for f in df.schema:
        value = column(f.name)
        if isinstance(f.dataType, T.TimestampType):
            value = to_millis(value)
        elif isinstance(f.dataType, T.TimestampNTZType):
            value = ntz_to_millis(value)
        elif f.name in decimals:
            value = rescale_decimal(value, *decimals[f.name])
        pick.append(value.alias(f.name, metadata=f.metadata))
    return df.select(*pick)


def infer_jdbc_schema(
    spark: SparkSession, source: SourceRef, table: str, custom_schema: str | None = None, describe: bool = False
) -> T.StructType:
    """Schema of a table; ``customSchema`` pins types, ``describe`` adds where each column is from."""
    options = connection_options(source)
    if custom_schema:
        options["customSchema"] = custom_schema
    schema = load(spark, JdbcScan(options, quote_ident(table))).schema
    return with_origin(schema, source.database, table) if describe else schema


def with_origin(schema: T.StructType, database: str | None, table: str) -> T.StructType:
    """Record database, table, column and type in each field's metadata."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                f.dataType,
                f.nullable,
                # Names of the metadata entries.
                {
                    **f.metadata,
                    "SQL_CATALOG_NAME": database or "",
                    "SQL_TABLE_NAME": table,
                    "SQL_COLUMN_NAME": f.name,
                    "SQL_TYPE": f.dataType.simpleString(),
                },
            )
            for f in schema
        ]
    )


def type_overrides(schema: T.StructType, by_name=None, by_index=None) -> str:
    """``customSchema`` text from type overrides by column name or 1-based index."""
    by_name, names = dict(by_name or {}), schema.names
    for index, kind in (by_index or {}).items():
        if not 1 <= index <= len(names):
            raise MissingFieldError(f"no column number {index}")
        by_name[names[index - 1]] = kind
    unknown = [n for n in by_name if n not in names]
    if unknown:
        raise MissingFieldError(f"no such column: {', '.join(unknown)}")
    return ", ".join(
        f"{quote_ident(n)} {k if isinstance(k, str) else k.simpleString()}" for n, k in by_name.items()
    )


def index_sql(database: str | None, table: str) -> str:
    """The database's own list of a table's indexes and their columns."""
    where = f"TABLE_NAME = {quote_text(table)}"
    where += f" AND TABLE_SCHEMA = {quote_text(database)}" if database else " AND TABLE_SCHEMA = DATABASE()"
    return (
        "SELECT INDEX_NAME AS index_name, NON_UNIQUE AS non_unique, SEQ_IN_INDEX AS seq, "
        f"COLUMN_NAME AS column_name FROM information_schema.STATISTICS WHERE {where}"
    )


def index_profile(statistics: DataFrame) -> DataFrame:
    """``(index_name, is_unique, columns)`` from index statistics rows."""
    return statistics.groupBy("index_name").agg(
        (F.max(F.col("non_unique").cast("int")) == 0).alias("is_unique"),
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "column_name"))), lambda c: c["column_name"]).alias(
            "columns"
        ),
    )


def primary_key_of(profile: DataFrame) -> str | None:
    """First column of the primary key, if the table has one."""
    row = profile.where(F.col("index_name") == "PRIMARY").select(F.get("columns", F.lit(0))).first()
    return row[0] if row else None


def read_indexes(spark: SparkSession, source: SourceRef, table: str) -> DataFrame:
    """Index profile of a live table."""
    return index_profile(query(spark, connection_options(source), index_sql(source.database, table)))
