"""Write rows of bytes as files: the chunks of each file, in order.

Input rows are ``(name, chunk_no, binary_data)``. On a disk that all executors
mount, every chunk gets its byte offset first and is then written in place by
whichever task holds it, so a file of any size is written by many tasks at
once. Offsets come from the chunk sizes alone, or are given; the bytes are
never sorted.
Stores that only accept whole objects get one ordered stream per file, through
one task, in constant memory.

Both ways write below a staging folder that is moved to the target once every
row is on disk; a repeated task writes the same bytes again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError, MissingFieldError
from quayline.session import configure, staged
from quayline.sources import filesystem
from quayline.sources.binary import FILE_CHUNK, arrow_options, in_tasks, open_filesystem, read_binary

# A list of this many file names, some ten megabytes, is copied to every executor; a longer one is not.
BROADCAST_FILES = 50_000
# Offsets are two numbers each: this many take some ten megabytes.
BROADCAST_OFFSETS = 500_000
OPEN_FILES = 128
_DONE = "name string, chunks bigint, bytes bigint"


def write_binary(
    df: DataFrame,
    path: str,
    name: str = "name",
    order: str = "chunk_no",
    layout: str | None = None,
    offset: str | None = None,
) -> dict[str, int]:
    """Replace folder ``path`` by the files the rows describe; NULL chunks are skipped.

    ``layout`` is ``'offset'`` (shared disk) or ``'stream'`` (whole objects);
    by default the scheme of ``path`` decides. A column ``offset`` with each
    chunk's byte position, where it is known, saves working it out: the write
    then needs no shuffle and no staging. Returns chunk and byte totals.
    """
    spark = configure(df.sparkSession)
    for needed in (name, order, "binary_data"):
        if needed not in df.columns:
            raise MissingFieldError(f"binary output needs column {needed!r}")
    target = filesystem.qualified(spark, path)
    layout = layout or ("offset" if target.startswith("file:") else "stream")
    options = arrow_options(spark, target)
    if options is None:
        raise InvalidParameterError(f"cannot write single files to {target}")
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    attempts = f"{staging}.attempts"
    present = df.where(F.col("binary_data").isNotNull())
    name = _inside(F.col(name))
    rows = present.select(name.alias("name"), F.col(order).cast("bigint").alias("chunk_no"), "binary_data")

    filesystem.make_directory(spark, staging)
    try:
        if layout == "offset" and offset:
            known = present.select(name.alias("name"), F.col(offset).alias("start"), "binary_data")
            written = known.mapInArrow(_offset_writer(staging), _DONE)
        elif layout == "offset":
            kept = rows.select(
                F.monotonically_increasing_id().alias("row_id"), "*", F.octet_length("binary_data").alias("size")
            )
            # ORC takes values of megabytes at about twice the speed of Parquet.
            chunks = staged(spark, kept, "chunks", "orc")
            placed = _place(chunks, small=chunks.count() <= BROADCAST_OFFSETS)
            written = placed.mapInArrow(_offset_writer(staging), _DONE)
        elif layout == "stream":
            ordered = rows.repartition("name").sortWithinPartitions("name", "chunk_no")
            written = ordered.mapInArrow(_stream_writer(staging, attempts, options), _DONE)
        else:
            raise InvalidParameterError(f"layout must be 'offset' or 'stream', not {layout!r}")
        totals = written.agg(F.sum("chunks").alias("chunks"), F.sum("bytes").alias("bytes")).first()
        _check_stored(spark, staging, totals["bytes"] or 0)
        filesystem.swap(spark, staging, target)
    except BaseException:
        filesystem.delete(spark, staging)
        raise
    finally:
        filesystem.delete(spark, attempts)
    return {"chunks": totals["chunks"] or 0, "bytes": totals["bytes"] or 0}


def merge_files(
    spark: SparkSession, folder: str, path: str, name: str, first: bytes = b"", layout: str | None = None
) -> dict[str, int]:
    """Join the files below ``folder``, in name order and after ``first``, into one file of ``path``.

    File lengths give every chunk's position, so the bytes move from many tasks
    without a shuffle; only the list of file names is ordered in one place.
    """
    chunks = read_binary(spark, folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    # Task and file numbers count as numbers: part-100000 comes after part-99999.
    numbers = [F.regexp_extract("path", p, 1).try_cast("int") for p in (r"part-(\d+)-", r"-c(\d+)\.")]
    by_name = W.orderBy(*numbers, "path")
    placed = files.select(
        "path",
        F.row_number().over(by_name).alias("rank"),
        (F.sum("length").over(by_name.rowsBetween(W.unboundedPreceding, 0)) - F.col("length")).alias("before"),
    )
    if placed.count() <= BROADCAST_FILES:
        placed = F.broadcast(placed)
    rows = chunks.join(placed, "path").select(
        F.lit(name).alias("name"),
        # Room for 2^31 chunks per file.
        (F.shiftleft(F.col("rank").cast("bigint"), 31) + F.col("chunk_no")).alias("chunk_no"),
        (F.col("before") + F.col("chunk_no") * FILE_CHUNK + len(first)).alias("offset"),
        "binary_data",
    )
    if first:
        head = spark.range(1).select(
            F.lit(name).alias("name"),
            F.lit(0).cast("bigint").alias("chunk_no"),
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(bytearray(first)).alias("binary_data"),
        )
        rows = rows.unionByName(head)
    return write_binary(rows, path, layout=layout, offset="offset")


def _inside(name):
    """A file name, refused where it is absolute or would leave the target folder."""
    leaves = name.isNull() | (name == "") | name.startswith("/") | name.rlike(r"(^|/)\.\.(/|$)")
    message = F.concat(F.lit("file name leaves the target folder: "), F.coalesce(name, F.lit("NULL")))
    return F.when(leaves, F.raise_error(message).cast("string")).otherwise(name)


def _check_stored(spark: SparkSession, folder: str, expected: int) -> None:
    """Refuse to publish a folder that holds fewer bytes than its tasks have written.

    That is so where executors took a disk of their own for a shared one.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    stored = in_tasks(files.select("length")).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    if stored < expected:
        raise OSError(f"{folder} holds {stored} of {expected} bytes written: not a disk that all executors share")


def _place(rows: DataFrame, small: bool = False) -> DataFrame:
    """Add each chunk's byte offset in its file.

    Sizes are dealt into even ranges of (name, order), whatever the names and
    order numbers are; running sums go over the ranges, then over their totals,
    one for each range a file has a part in. A ``small`` list of offsets is sent
    to the bytes; otherwise both meet in a shuffle.
    """
    spark = rows.sparkSession
    sizes = rows.select("row_id", "name", "chunk_no", "size")
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sizes = sizes.repartitionByRange(ranges, "name", "chunk_no", "row_id")
    # Written once: the range a chunk falls into comes from a sample.
    sizes = staged(spark, sizes.withColumn("segment", F.spark_partition_id()), "sizes")
    totals = sizes.groupBy("name", "segment").agg(F.sum("size").alias("total"))
    earlier = W.partitionBy("name").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "name", "segment", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("segment_start")
    )
    before = (
        W.partitionBy("name", "segment").orderBy("chunk_no", "row_id").rowsBetween(W.unboundedPreceding, -1)
    )
    inside = sizes.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    offsets = inside.join(starts, ["name", "segment"]).select(
        "row_id", (F.col("segment_start") + F.col("inside")).alias("start")
    )
    # Hashing the offsets leaves the bytes unsorted; row ids spread them evenly.
    offsets = F.broadcast(offsets) if small else offsets.hint("shuffle_hash")
    return (
        rows.select("row_id", "name", "binary_data")
        .join(offsets, "row_id")
        .select("name", "start", "binary_data")
    )


def _offset_writer(staging: str):
    def write(batches):
        import os

        import pyarrow as pa

        _, root = open_filesystem(staging)
        handles: dict[str, int] = {}
        folders: set[str] = set()

        def close_all():
            for handle in handles.values():
                os.close(handle)
            handles.clear()

        try:
            for batch in batches:
                names, sizes = [], []
                for name, start, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if name not in handles:
                        if len(handles) >= OPEN_FILES:
                            close_all()
                        target = os.path.join(root, name)
                        if os.path.dirname(target) not in folders:
                            os.makedirs(os.path.dirname(target), exist_ok=True)
                            folders.add(os.path.dirname(target))
                        # No truncation: other tasks write other ranges of the same file.
                        handles[name] = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
                    view, at = memoryview(data), start
                    while view:
                        n = os.pwrite(handles[name], view, at)
                        view, at = view[n:], at + n
                    names.append(name)
                    sizes.append(len(data))
                yield _done(pa, names, sizes)
        finally:
            close_all()

    return write


def _stream_writer(staging: str, attempts: str, options: dict):
    def write(batches):
        import posixpath
        import uuid

        import pyarrow as pa
        from pyarrow.fs import FileType

        fs, root = open_filesystem(staging, options)
        _, spare = open_filesystem(attempts, options)
        current = stream = temporary = None

        def close():
            stream.close()
            target = posixpath.join(root, current)
            fs.create_dir(posixpath.dirname(target), recursive=True)
            if fs.get_file_info(target).type != FileType.NotFound:
                # An earlier attempt of this task got that far.
                fs.delete_file(target)
            fs.move(temporary, target)

        for batch in batches:
            names, sizes = [], []
            for name, _, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if name != current:
                    if stream is not None:
                        close()
                    current = name
                    fs.create_dir(spare, recursive=True)
                    temporary = posixpath.join(spare, uuid.uuid4().hex)
                    stream = fs.open_output_stream(temporary)
                stream.write(data)
                names.append(name)
                sizes.append(len(data))
            yield _done(pa, names, sizes)
        if stream is not None:
            close()

    return write


def _done(pa, names, sizes):
    return pa.RecordBatch.from_pydict(
        {
            "name": pa.array(names, pa.string()),
            "chunks": pa.array([1] * len(names), pa.int64()),
            "bytes": pa.array(sizes, pa.int64()),
        }
    )
