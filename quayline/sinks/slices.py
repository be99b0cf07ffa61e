"""Files of bounded size: rows go into the open slice until the next one would not fit.

A task numbers its rows by their running width and writes every number to a file of its own;
nothing is shuffled, and a wide row costs only itself. Rows stay in the JVM: just the widths pass
through Python. The files are written below a staging folder and moved into one flat folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.session import configure
from quayline.sources import filesystem

SLICE = "__slice"


def slice_number(width: Column, bound: int) -> Column:
    """The running number of the slice a row belongs to, within its task.

    A slice holds one row at least, so a row wider than ``bound`` is a slice of its own.
    """
    if bound <= 0:
        raise InvalidParameterError(f"a slice must have room for a byte, not {bound}")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        number, held = 0, 0
        for widths in batches:
            ends = np.cumsum(widths.to_numpy(dtype=np.int64))
            out = np.empty(len(ends), dtype=np.int32)
            at, base = 0, 0
            while at < len(ends):
                stop = max(at, int(np.searchsorted(ends, base + bound - held, side="right")))
                if stop == at and held:
                    number, held = number + 1, 0
                    continue
                stop = max(stop, at + 1)
                out[at:stop] = number
                held, base, at = held + int(ends[stop - 1]) - base, int(ends[stop - 1]), stop
            yield pd.Series(out)

    # Python evaluates annotations late here, and Spark asks for them.
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "int").asNondeterministic()(width.cast("bigint"))


def write_slices(df: DataFrame, path: str, width: Column, bound: int, write: Callable[[DataFrame, str, str | None], None]) -> None:
    """Replace folder ``path`` by files of at most ``bound`` bytes, as ``width`` measures rows.

    ``write(df, folder, column)`` writes a frame, by the values of ``column`` where one is named.
    """
    spark = configure(df.sparkSession)
    target = filesystem.qualified(spark, path)
    staging = f"{target}.slices-{uuid.uuid4().hex}"
    flat = f"{staging}.flat"
    try:
        write(df.withColumn(SLICE, slice_number(width, bound)), staging, SLICE)
        files = filesystem.files(spark, staging)
        if not files:
            # Without a row there is no slice; the schema is written all the same.
            write(df, flat, None)
        for folder, name in files:
            number = int(folder.rpartition("=")[2])
            task, _, rest = name.removeprefix("part-").partition("-")
            filesystem.move(spark, f"{folder}/{name}", f"{flat}/part-{task}-{number:06d}-{rest}")
        filesystem.swap(spark, flat, target)
    finally:
        filesystem.delete(spark, staging)
        filesystem.delete(spark, flat)
