"""Warehouse table output: create, align, overwrite one partition."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, InvalidPartitionSpecError
from quayline.functions.literal import quote_ident, quote_text
from quayline.operators.columns import align_to_table, column, dropped_columns
from quayline.operators.filters import parse_partition_spec
from quayline.session import configure
from quayline.sinks.binary import write_binary
from quayline.sources.warehouse import partition_columns, table_name
from quayline.types import warehouse_type

log = logging.getLogger(__name__)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_spec: str | None = None,
    location: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create the table if absent; the keys of the spec become partition columns.

    A key found in the schema keeps its type, any other becomes a string.
    """
    keys = list(parse_partition_spec(partition_spec))
    by_name = {f.name.lower(): f for f in schema}
    taken = {k.lower() for k in keys}
    plain = [f for f in schema if f.name.lower() not in taken]
    if not plain:
        raise InvalidParameterError("a table needs a column that is not a partition key")
    parts = [by_name.get(k.lower(), T.StructField(k, T.StringType())) for k in keys]
    columns = ", ".join(f"{quote_ident(f.name)} {warehouse_type(f.dataType).simpleString()}" for f in plain + parts)
    ddl = f"CREATE TABLE IF NOT EXISTS {table_name(name)} ({columns}) USING {fmt}"
    if parts:
        ddl += " PARTITIONED BY (" + ", ".join(quote_ident(f.name) for f in parts) + ")"
    if location:
        ddl += f" LOCATION {quote_text(location)}"
    spark.sql(ddl)


def write_table(
    df: DataFrame,
    name: str,
    partition_spec: str | None = None,
    create: bool = True,
    location: str | None = None,
) -> None:
    """Overwrite a table, or exactly the partition the spec names.

    Columns match by name in any case; unknown ones are dropped with a
    warning, absent ones become NULL, values are converted to the table's types.
    """
    spark = configure(df.sparkSession)
    if create:
        create_table(spark, name, df.schema, partition_spec, location)
    table = table_name(name)
    keys = partition_columns(spark, name)
    pairs = {k.lower(): v for k, v in parse_partition_spec(partition_spec).items()}
    if keys and not pairs:
        raise InvalidPartitionSpecError(f"table {name} is partitioned; a partition spec is required")
    if keys and set(pairs) != {k.lower() for k in keys}:
        raise InvalidPartitionSpecError(f"table {name} is partitioned by {', '.join(keys)}")

    is_key = {k.lower() for k in keys}
    target = T.StructType([f for f in spark.table(table).schema if f.name.lower() not in is_key])
    lost = [c for c in dropped_columns(df, target) if c.lower() not in is_key]
    if lost:
        log.warning("table %s has no column %s: dropped", name, ", ".join(lost))
    rows = align_to_table(df.select(*[df[quote_ident(c)] for c in df.columns if c.lower() not in is_key]), target)

    # A static spec replaces that partition alone, also when there are no rows.
    clause = ""
    if keys:
        clause = " PARTITION (" + ", ".join(f"{quote_ident(k)} = {quote_text(pairs[k.lower()])}" for k in keys) + ")"
    spark.sql(f"INSERT OVERWRITE TABLE {table}{clause} SELECT * FROM {{rows}}", rows=rows)


def write_partitions(df: DataFrame, name: str) -> None:
    """Overwrite the partitions that occur in ``df``, each taken from its own columns.

    Rows are gathered by partition first, or every task would leave a small
    file in every partition; adaptive execution splits the large partitions
    among tasks and joins the small ones.
    """
    spark = configure(df.sparkSession)
    keys = partition_columns(spark, name)
    rows = align_to_table(df, spark.table(table_name(name)).schema)
    if keys and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", *[column(k) for k in keys])
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    # insertInto takes the mode from the session only; the write is done when it returns.
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table_name(name))
    finally:
        spark.conf.set(mode, before)


def write_resource(
    df: DataFrame, path: str, name: str = "name", order: str = "chunk_no", offset: str | None = None
) -> dict[str, int]:
    """Create or replace named blobs, each from all of its chunks."""
    return write_binary(df, path, name, order, offset=offset)
