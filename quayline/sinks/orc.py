"""ORC and Parquet output."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quayline.errors import InvalidParameterError
from quayline.operators.paging import row_bytes
from quayline.sinks.slices import write_slices

# Compression names accepted, and the default block and stripe sizes.
ORC_COMPRESSION = {
    "uncompressed": "none",
    "none": "none",
    "snappy": "snappy",
    "gzip": "zlib",
    "zlib": "zlib",
    "zstd": "zstd",
    "lz4": "lz4",
    "lz4_frame": "lz4",
    "lz4_hadoop": "lz4",
    "lzo": "lzo",
}
ORC_BLOCK_BYTES = 64 * 1024
ORC_STRIPE_BYTES = 64 * 1024 * 1024


def write_orc(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "uncompressed",
    block_bytes: int = ORC_BLOCK_BYTES,
    stripe_bytes: int = ORC_STRIPE_BYTES,
    max_records_per_file: int | None = None,
    slice_bytes: int | None = None,
) -> None:
    """Write ORC files; an empty frame still leaves a file with its schema.

    ``slice_bytes`` bounds each file by the size of its values in memory.
    """
    codec = ORC_COMPRESSION.get(compression.lower())
    if codec is None:
        raise InvalidParameterError(f"ORC compression {compression!r} is not available")
    options = {"compression": codec, "orc.compress.size": block_bytes, "orc.stripe.size": stripe_bytes}
    _write(df, "orc", path, mode, options, max_records_per_file, slice_bytes)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    max_records_per_file: int | None = None,
    slice_bytes: int | None = None,
) -> None:
    """Write Parquet files; ``slice_bytes`` bounds each by the size of its values in memory."""
    _write(df, "parquet", path, mode, {"compression": compression}, max_records_per_file, slice_bytes)


def _write(df: DataFrame, fmt: str, path: str, mode: str, options: dict, max_records: int | None, slice_bytes: int | None) -> None:
    if not slice_bytes:
        limit = {"maxRecordsPerFile": max_records} if max_records else {}
        df.write.mode(mode).options(**options, **limit).format(fmt).save(path)
        return
    if max_records or mode != "overwrite":
        raise InvalidParameterError("slices are written anew and not bounded by rows")

    def write(rows: DataFrame, folder: str, column: str | None) -> None:
        writer = rows.write.options(**options).format(fmt)
        (writer.partitionBy(column) if column else writer).save(folder)

    write_slices(df, path, row_bytes(df.schema), slice_bytes, write)
