"""Registered queries and, side by side, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.refs import SourceRef
from quayline.session import configure, scratch_path, scratch_root
from quayline.sources import filesystem

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        QUERIES[fn.__name__] = run
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


class Tables:
    """The given tables, and fresh places in the shared folder to write to."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def source(self) -> SourceRef:
        return SourceRef("localfs", id="shared", path=filesystem.qualified(self.spark, scratch_root(self.spark)))

    def relative(self, label: str) -> str:
        return self.path(label).rsplit("/", 1)[1]


#: All elements of ``embedding`` as text, in millionths, which both sides write alike.
ELEMENTS_SQL = "array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',')"


def elements(name: str) -> Column:
    """All elements of an array of numbers as text, in millionths."""
    millionths = F.transform(name, lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string"))
    return F.array_join(millionths, ",")
