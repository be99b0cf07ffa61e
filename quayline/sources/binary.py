"""Files as rows of bytes: ``(path, chunk_no, binary_data)``.

Small files are read by Spark's own ``binaryFile`` source. Files above
``inline_bytes`` are cut into byte ranges that separate tasks read, so one
huge file neither has to fit in memory nor ties up a single task.
"""

from __future__ import annotations

import math
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.session import configure
from quayline.sources import filesystem

# Chunk sizes of plain files, named resources and client reads.
FILE_CHUNK = 3 * 1024 * 1024
RESOURCE_CHUNK = 1024
CLIENT_CHUNK = 128 * 1024

INLINE_BYTES = 64 * 1024 * 1024
RANGE_BYTES = 64 * 1024 * 1024
# Bytes of small files that one task reads.
TASK_BYTES = 32 * 1024 * 1024

# Schemes Arrow can open.
_ARROW_SCHEMES = ("file", "s3", "s3a", "s3n", "hdfs", "viewfs", "gs", "gcs", "abfs", "abfss")

CHUNK_SCHEMA = "path string, chunk_no bigint, binary_data binary"


def read_binary(
    spark: SparkSession,
    path,
    chunk_bytes: int = FILE_CHUNK,
    inline_bytes: int = INLINE_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Every file below ``path`` as chunks of at most ``chunk_bytes``; an empty file is one empty chunk."""
    configure(spark)
    if chunk_bytes <= 0:
        raise InvalidParameterError(f"chunk size must be positive, not {chunk_bytes}")
    options = arrow_options(spark, path)
    if options is None:
        # Spark reads files of up to 2 GiB here, and refuses larger ones.
        inline_bytes = 2**31 - 1
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Listing only: without the content column no file is opened.
    large = files.where(F.col("length") > inline_bytes).select("path", "length")
    found = in_tasks(files.select("length")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("length") > inline_bytes, F.col("length"))).alias("bytes"),
        F.sum("length").alias("all_bytes"),
    )
    found = found.first()
    total = None if options is None else found["bytes"]

    small = files.where((F.col("length") <= inline_bytes) | F.lit(options is None))
    small = in_tasks(small, found["all_bytes"] or 0)
    chunk_count = F.ceil(F.col("length") / chunk_bytes).cast("bigint")
    chunks = small.select(
        "path", "content", F.explode(F.sequence(F.lit(0).cast("bigint"), chunk_count - 1)).alias("chunk_no")
    ).select(
        "path",
        "chunk_no",
        F.substring("content", (F.col("chunk_no") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)).alias(
            "binary_data"
        ),
    )
    if total:
        chunks = chunks.unionByName(_read_ranges(large, total, chunk_bytes, range_bytes, options))
    names = filesystem.input_files(files)
    if len(names) > found["n"]:
        chunks = chunks.unionByName(_empty_files(files, names))
    return chunks


def in_tasks(files: DataFrame, held: int = 0) -> DataFrame:
    """``files`` in as many tasks as ``held`` bytes are worth: Spark takes every file for 4 MiB at least, and makes a task of 32 small ones."""
    return files.coalesce(max(2 * files.sparkSession.sparkContext.defaultParallelism, math.ceil(held / TASK_BYTES)))


def _empty_files(files: DataFrame, names: list[str]) -> DataFrame:
    """One empty chunk for each file that the index lists but no scan delivers.

    Spark leaves files without a byte out of its scans. The index holds their
    names on the driver as it does those of all files.
    """
    paths = [(re.sub(r"^file:/+", "file:/", unquote(n)),) for n in names]
    listed = files.sparkSession.createDataFrame(paths, "path string")
    empty = listed.join(in_tasks(files.select("path")), "path", "left_anti")
    return empty.select("path", F.lit(0).cast("bigint").alias("chunk_no"), F.lit(b"").alias("binary_data"))


def _read_ranges(large: DataFrame, total: int, chunk_bytes: int, range_bytes: int, options: dict) -> DataFrame:
    per_range = max(1, range_bytes // chunk_bytes)
    span = per_range * chunk_bytes
    last = F.ceil(F.col("length") / span).cast("bigint") - 1
    ranges = large.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("range_no"))
    # The rows are a few bytes each but stand for megabytes: fix the task count.
    cores = large.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(total / max(span, RANGE_BYTES)))
    return ranges.repartition(tasks, "path", "range_no").mapInArrow(
        _range_reader(chunk_bytes, per_range, options), CHUNK_SCHEMA
    )


def _range_reader(chunk_bytes: int, per_range: int, options: dict):
    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, range_no in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = open_filesystem(path, options)
                with fs.open_input_file(name) as stream:
                    first = range_no * per_range
                    for chunk_no in range(first, first + per_range):
                        data = stream.read_at(chunk_bytes, chunk_no * chunk_bytes)
                        if data:
                            yield pa.RecordBatch.from_pydict(
                                {
                                    "path": pa.array([path], pa.string()),
                                    "chunk_no": pa.array([chunk_no], pa.int64()),
                                    "binary_data": pa.array([data], pa.binary()),
                                }
                            )
                        if len(data) < chunk_bytes:
                            break

    return read


def read_ranges(pieces: DataFrame, chunk_bytes: int, options: dict) -> DataFrame:
    """The chunks of pieces of files ``(path, start, stop)`` that begin at whole chunks, where the pieces are."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                fs, name = open_filesystem(row["path"], options)
                with fs.open_input_file(name) as stream:
                    for at in range(row["start"], row["stop"], chunk_bytes):
                        data = stream.read_at(min(chunk_bytes, row["stop"] - at), at)
                        columns = [pa.array([row["path"]], pa.string()), pa.array([at // chunk_bytes], pa.int64()), pa.array([data], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, ["path", "chunk_no", "binary_data"])

    return pieces.select("path", "start", "stop").mapInArrow(read, CHUNK_SCHEMA)


def arrow_options(spark: SparkSession, path: str) -> dict[str, str] | None:
    """What tasks need to open ``path`` with Arrow; None if Arrow has no such file system."""
    scheme, _, rest = path.partition("://")
    if not rest:
        return {}
    if scheme not in _ARROW_SCHEMES:
        return None
    if not scheme.startswith("s3"):
        return {}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return s3_options(conf.get, rest.partition("/")[0])


def s3_options(get, bucket: str) -> dict[str, str]:
    """Connection settings of one bucket from the Hadoop ones, the bucket's own first."""

    def setting(name):
        return get(f"fs.s3a.bucket.{bucket}.{name}") or get(f"fs.s3a.{name}")

    options = {
        "access_key": setting("access.key"),
        "secret_key": setting("secret.key"),
        "endpoint_override": setting("endpoint"),
        "scheme": "http" if setting("connection.ssl.enabled") == "false" else "https",
    }
    return {k: v for k, v in options.items() if v}


def open_filesystem(uri: str, options: dict[str, str] | None = None):
    """The Arrow file system of a path as Spark prints it, and the path inside it."""
    from pyarrow import fs

    if uri.startswith("file:") or uri.startswith("/"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    scheme, _, rest = uri.partition("://")
    if scheme.startswith("s3"):
        return fs.S3FileSystem(**(options or {})), rest
    return fs.FileSystem.from_uri(uri)
