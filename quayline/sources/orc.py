"""ORC and Parquet scans with projection by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayline.errors import MissingFieldError
from quayline.operators.columns import project, resolve_case_insensitive
from quayline.session import configure


def read_columnar(
    spark: SparkSession, path, fmt: str = "orc", columns=None, schema: T.StructType | None = None
) -> DataFrame:
    """Read ORC or Parquet files; only the wanted columns are decoded.

    Columns match a declared ``schema`` in any case; one the files lack is an error.
    """
    df = configure(spark).read.format(fmt).load(path)
    if schema is not None:
        have = {c.lower() for c in df.columns}
        missing = [n for n in schema.names if n.lower() not in have]
        if missing:
            raise MissingFieldError(f"not in the files: {', '.join(missing)}")
        df = resolve_case_insensitive(df, schema)
    return project(df, columns)
