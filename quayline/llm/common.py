"""What the corpus operators share: text as bytes, worker state, sampling keys."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.session import configure
from quayline.sources import filesystem

#: Bytes of an Arrow batch where batches are small.
BATCH_BYTES = 2 << 20
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(column: str) -> Column:
    """The text's UTF-8 bytes, a null text counting as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def worker_state(key: str, make: Callable):
    """An object kept in a Python worker process until another one is asked for.

    Task functions travel by value, so their module globals start afresh in
    every task; tokenizers and caches should not. What an earlier operator has
    left in the worker goes, so that a pipeline needs no more than its largest stage.
    """
    holder = sys.modules.setdefault("quayline_worker_state", types.ModuleType("quayline_worker_state"))
    if getattr(holder, "key", None) != key:
        if getattr(holder, "key", None) is not None:
            holder.key = holder.value = None
            give_back()
        holder.value = make()
        holder.key = key
    return holder.value


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    usual = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def small_batches(spark: SparkSession):
    """For work that takes several times the room of its texts in a worker: texts come in smaller batches meanwhile."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shuffles_cleaned(spark: SparkSession):
    """For work in many staged steps: what a step has shuffled is deleted when it is written, not at some later time."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again; what was made of them has been written by then."""
    for df in tables:
        folders = {os.path.dirname(f) for f in df.inputFiles()}
        if len(folders) > 1 or not all(os.path.basename(f).startswith("quayline-") for f in folders):
            raise ValueError("only a table that was staged as it is can be discarded")
        for folder in folders:
            filesystem.delete(df.sparkSession, folder)


def give_back() -> None:
    """Hand memory that is free but still held by the allocators back to the machine, where they can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tasks_for(spark: SparkSession) -> int:
    """The number of partitions for a shuffle whose count has to be named."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
