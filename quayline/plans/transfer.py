"""Read, write and copy datasets by reference."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, SourceUnavailableError
from quayline.operators.columns import project
from quayline.operators.filters import text_filter
from quayline.refs import FILE_KINDS, ContentType, DatasetRef, FileFormat, SourceRef, StorageKind, resolve
from quayline.session import configure
from quayline.sinks.binary import write_binary
from quayline.sinks.csv import render_csv, write_csv
from quayline.sinks.jdbc import write_jdbc
from quayline.sinks.orc import write_orc, write_parquet
from quayline.sinks.warehouse import write_resource, write_table
from quayline.sources import filesystem
from quayline.sources.binary import FILE_CHUNK, read_binary
from quayline.sources.csv import infer_csv_schema, read_csv
from quayline.sources.jdbc import PING_QUERY, connection_options, infer_jdbc_schema, query, read_jdbc
from quayline.sources.orc import read_columnar
from quayline.sources.warehouse import read_resource, read_table, table_name

BINARY_SCHEMA = T.StructType([T.StructField("binary_data", T.BinaryType(), False)])
# Fixed value: the slice size of an upload that names no other.
UPLOAD_SLICE_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class WriteResult:
    """What a finished write put where."""

    rows: int
    location: str


def read_dataset(
    spark: SparkSession,
    ref: DatasetRef,
    columns=None,
    content_type: str = "table",
    partition_spec: str | None = None,
    where: str | None = None,
    limit: int | None = None,
    **options,
) -> DataFrame:
    """A dataset as a lazy DataFrame.

    ``content_type`` asks for typed columns (``table``), the stored bytes
    (``raw``) or lines of CSV text (``csv``). ``limit`` takes that many rows as
    a sample. ``columns``, ``where`` and ``limit`` hold for bytes too, over their
    columns ``path``, ``chunk_no`` and ``binary_data``. ``options`` go to the reader.
    """
    configure(spark)
    content = ContentType(content_type)
    spec = resolve(ref, "table" if content is ContentType.CSV and ref.structured else content_type)
    if ref.source.storage in FILE_KINDS:
        ref.source.apply(spark)
    if partition_spec and spec.reader != "warehouse":
        raise InvalidParameterError("only warehouse tables have a partition spec")
    if spec.reader in ("binary", "resource"):
        read = read_binary if spec.reader == "binary" else read_resource
        df = project(text_filter(read(spark, spec.location, **options), where), columns)
        return df if limit is None else df.limit(limit)
    if spec.reader == "csv":
        # The filter may use columns outside the projection, so it comes first.
        df = read_csv(spark, spec.location, ref.columns, None if where else columns, ref.csv, **options)
        df = project(text_filter(df, where), columns)
    elif spec.reader == "jdbc":
        table = ref.table
        df = read_jdbc(
            spark, ref.source, ref.relative_uri, columns, where, table.pages, table.primary_key, table.field_map, **options
        )
    elif spec.reader == "warehouse":
        df = project(text_filter(read_table(spark, spec.location, None, spec.schema, partition_spec), where), columns)
    else:
        df = read_columnar(spark, spec.location, spec.reader, None, spec.schema)
        df = project(text_filter(df, where), columns)
    if limit is not None:
        df = df.limit(limit)
    return render_csv(df, ref.csv) if content is ContentType.CSV else df


def infer_schema(spark: SparkSession, ref: DatasetRef) -> T.StructType:
    """The declared schema if there is one, else the one found in storage."""
    spec = resolve(ref)
    if spec.schema is not None:
        return spec.schema
    if spec.reader in ("binary", "resource"):
        return BINARY_SCHEMA
    if spec.reader == "csv":
        return infer_csv_schema(spark, spec.location, ref.csv)
    if spec.reader == "jdbc":
        return infer_jdbc_schema(spark, ref.source, ref.relative_uri)
    if spec.reader == "warehouse":
        return spark.table(table_name(spec.location)).schema
    return spark.read.format(spec.reader).load(spec.location).schema


def write_dataset(
    df: DataFrame,
    ref: DatasetRef,
    content_type: str = "table",
    partition_spec: str | None = None,
    slice_bytes: int | None = None,
    **options,
) -> WriteResult:
    """Write a dataset, replacing what is there, and report the rows written.

    ``slice_bytes`` bounds the length of each file of a CSV dataset, and the size in memory of what
    a columnar file holds: a task opens the next file where a row would not fit. ``raw`` content takes ``(name, chunk_no, binary_data)`` rows. A frame that
    reads from the place it would replace is refused.
    """
    spark = configure(df.sparkSession)
    spec = resolve(ref, content_type)
    if ref.source.storage in FILE_KINDS:
        ref.source.apply(spark)
    if partition_spec and spec.reader != "warehouse":
        raise InvalidParameterError("only warehouse tables have a partition spec")
    if slice_bytes:
        if spec.reader not in ("csv", "orc", "parquet"):
            raise InvalidParameterError("only file datasets of rows are written in slices")
        options["slice_bytes"] = slice_bytes
    if spec.reader in ("binary", "resource", "csv", "orc", "parquet"):
        _refuse_own_input(df, spec.location)
    if spec.reader in ("binary", "resource"):
        write = write_binary if spec.reader == "binary" else write_resource
        return WriteResult(write(df, spec.location, **options)["chunks"], spec.location)
    # The count sits in the stage that writes, where a repeated task counts once.
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if spec.reader == "csv":
        write_csv(rows, spec.location, ref.csv, **options)
    elif spec.reader == "orc":
        write_orc(rows, spec.location, **options)
    elif spec.reader == "parquet":
        write_parquet(rows, spec.location, **options)
    elif spec.reader == "warehouse":
        write_table(rows, spec.location, partition_spec, **options)
    else:
        write_jdbc(rows, ref.source, ref.relative_uri, fmt=ref.table, **options)
    return WriteResult(int(seen.get["rows"]), spec.location)


def _refuse_own_input(df: DataFrame, location: str) -> None:
    """Writing replaces the folder, so nothing below it may still have to be read."""
    spark = df.sparkSession
    root = filesystem.qualified(spark, location).rstrip("/")
    # Both as Spark prints them; its file index holds these names on the driver for any scan.
    roots = {_plain(root), _plain(quote(root, safe="/:"))}
    if any(name == r or name.startswith(r + "/") for name in map(_plain, filesystem.input_files(df)) for r in roots):
        raise InvalidParameterError(f"{location} is read by the rows that would replace it")


def _plain(uri: str) -> str:
    return re.sub(r"^file:/+", "/", uri)


def copy_dataset(
    spark: SparkSession,
    source: DatasetRef,
    target: DatasetRef,
    columns=None,
    partition_spec: str | None = None,
    slice_bytes: int | None = None,
    target_partition_spec: str | None = None,
    **options,
) -> WriteResult:
    """Copy a dataset into another storage or format; bytes are copied as bytes.

    ``partition_spec`` picks the rows of a source partition,
    ``target_partition_spec`` names the partition to replace. ``slice_bytes``
    bounds the size of each file written, without a shuffle; see ``write_dataset``.
    """
    if FileFormat(target.file_format) is FileFormat.BINARY:
        stored = resolve(source, "raw")
        if stored.reader not in ("binary", "resource"):
            raise InvalidParameterError("only a file dataset can be copied to a binary target")
        if columns or partition_spec or target_partition_spec or slice_bytes:
            raise InvalidParameterError("bytes are copied whole: no columns, partitions or slices")
        chunks = read_dataset(spark, source, content_type="raw", chunk_bytes=FILE_CHUNK)
        root = filesystem.qualified(spark, stored.location)
        if filesystem.is_directory(spark, root):
            name = F.substring("path", len(root.rstrip("/")) + 2, 2**31 - 1)
        else:
            name = F.element_at(F.split("path", "/"), -1)
        # Chunks are full but for the last, so their positions are known.
        named = chunks.withColumns({"name": name, "offset": F.col("chunk_no") * FILE_CHUNK})
        return write_dataset(named, target, "raw", offset="offset", **options)
    df = read_dataset(spark, source, columns, partition_spec=partition_spec)
    return write_dataset(df, target, partition_spec=target_partition_spec, slice_bytes=slice_bytes, **options)


def acks_by_file(df: DataFrame) -> DataFrame:
    """``(file, row_count)`` of a dataset read from files: what each write task delivered."""
    return (
        df.select(F.col("_metadata.file_name").alias("file"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def check_source(spark: SparkSession, source: SourceRef) -> bool:
    """Whether a source answers; raises if it does not."""
    kind = source.storage
    try:
        if kind is StorageKind.WAREHOUSE:
            return True
        if kind is StorageKind.MYSQL:
            query(spark, connection_options(source), PING_QUERY).first()
            return True
        source.apply(spark)
        found = filesystem.exists(spark, source.uri())
    except Exception as cause:
        raise SourceUnavailableError(f"data source {source.id or source.kind} does not answer") from cause
    if not found:
        raise SourceUnavailableError(f"{source.uri()} does not exist")
    return True

