"""Database output over JDBC, and the MySQL table definition it needs."""

from __future__ import annotations

import secrets
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, MissingFieldError
from quayline.functions import array_to_json, map_to_json
from quayline.functions.literal import quote_ident
from quayline.operators.columns import column
from quayline.refs import SourceRef, TableFormat
from quayline.session import configure
from quayline.sources.jdbc import connection_options
from quayline.types import mysql_type

# Key prefix length of text columns in an index, and table options.
TEXT_INDEX_LENGTH = 128
TABLE_OPTIONS = "ENGINE=InnoDB DEFAULT CHARSET=utf8mb4"


def synthetic_key() -> str:
    """A name for the key column of a table that declares none."""
    letters = string.ascii_lowercase + string.digits
    return "pk_" + "".join(secrets.choice(letters) for _ in range(6))


def mysql_ddl(
    table: str,
    schema: T.StructType,
    fmt: TableFormat | None = None,
    allow_drop: bool = False,
    timestamp_default: bool = True,
) -> list[str]:
    """Statements that prepare a MySQL table for the rows of ``schema``."""
    fmt = fmt or TableFormat()
    key = fmt.primary_key or synthetic_key()
    types = {f.name: f.dataType for f in schema}
    lines = [
        f"{quote_ident(n)} {mysql_type(t, timestamp_default)}" for n, t in types.items() if n != key
    ]
    lines.append(f"{quote_ident(key)} BIGINT PRIMARY KEY NOT NULL AUTO_INCREMENT")
    for i, index in enumerate(fmt.indexes):
        if not index.columns:
            continue
        missing = [c for c in index.columns if c not in types]
        if missing:
            raise MissingFieldError(f"indexed column does not exist: {', '.join(missing)}")
        parts = [
            quote_ident(c) + (f"({TEXT_INDEX_LENGTH})" if isinstance(types[c], T.StringType) else "")
            for c in index.columns
        ]
        keyword = "UNIQUE KEY" if index.unique else "INDEX"
        lines.append(f"{keyword} {quote_ident(f'idx_{i}')} ({', '.join(parts)})")
    name = quote_ident(table)
    create = f"CREATE TABLE {name} ({', '.join(lines)}) {TABLE_OPTIONS}"
    return [f"DROP TABLE IF EXISTS {name}", create] if allow_drop else [create]


def jdbc_projection(df: DataFrame) -> DataFrame:
    """Columns as the database takes them: maps and arrays as JSON text."""
    pick = []
    for f in df.schema:
        mysql_type(f.dataType)
        value = column(f.name)
        if isinstance(f.dataType, T.MapType):
            value = map_to_json(value)
        elif isinstance(f.dataType, T.ArrayType):
            value = array_to_json(value)
        pick.append(value.alias(f.name))
    return df.select(*pick)


def run_statements(spark: SparkSession, source: SourceRef, statements: list[str]) -> None:
    """Run table definitions over one driver-side connection."""
    jvm = spark._jvm
    options = connection_options(source)
    # The driver may come from spark.jars, which only the context class loader sees.
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = jvm.java.lang.Class.forName(options["driver"], True, loader).newInstance()
    properties = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            properties.setProperty(key, options[key])
    connection = driver.connect(options["url"], properties)
    try:
        for statement in statements:
            connection.createStatement().execute(statement)
    finally:
        connection.close()


# One database serves every executor.
MAX_CONNECTIONS = 100


def write_jdbc(
    df: DataFrame,
    source: SourceRef,
    table: str,
    mode: str = "append",
    fmt: TableFormat | None = None,
    allow_drop: bool = False,
    create: bool = False,
    batch_rows: int = 10_000,
    max_connections: int = MAX_CONNECTIONS,
) -> None:
    """Insert rows into a table.

    ``create`` runs the table definition first; with ``allow_drop`` an existing
    table goes. ``mode='overwrite'`` truncates and keeps the definition.
    A repeated task repeats its inserts where the table has no unique key.
    """
    if mode not in ("append", "overwrite"):
        raise InvalidParameterError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    spark = configure(df.sparkSession)
    rows = jdbc_projection(df)
    if create:
        run_statements(spark, source, mysql_ddl(table, df.schema, fmt, allow_drop))
    options = {
        **connection_options(source),
        "truncate": "true",
        "batchsize": str(batch_rows),
        "numPartitions": str(max_connections),
    }
    rows.write.format("jdbc").options(**options).option("dbtable", quote_ident(table)).mode(mode).save()
