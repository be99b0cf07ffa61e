"""Warehouse tables: partitioned tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayline.functions.literal import quote_ident
from quayline.operators.columns import project, resolve_case_insensitive
from quayline.operators.filters import check_name, partition_filter
from quayline.session import configure
from quayline.sources.binary import RESOURCE_CHUNK, read_binary


def table_name(name: str) -> str:
    """A checked, quoted table name; dots separate catalog, schema and table."""
    return ".".join(quote_ident(check_name(part, "table name")) for part in name.split("."))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a table, in order."""
    return [c.name for c in spark.catalog.listColumns(table_name(name)) if c.isPartition]


def read_table(
    spark: SparkSession,
    name: str,
    columns=None,
    schema: T.StructType | None = None,
    partition_spec: str | None = None,
) -> DataFrame:
    """Scan a table: partitions pruned by the spec, declared columns matched in any case."""
    configure(spark)
    df = spark.table(table_name(name))
    df = partition_filter(df, partition_spec, partition_columns(spark, name))
    if schema is not None:
        df = resolve_case_insensitive(df, schema)
    return project(df, columns)


def read_resource(spark: SparkSession, path: str, chunk_bytes: int = RESOURCE_CHUNK) -> DataFrame:
    """A named blob, or a folder of them, as rows of up to ``chunk_bytes``."""
    return read_binary(spark, path, chunk_bytes)
