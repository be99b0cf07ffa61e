"""Find the charset of every file of a text dataset.

One distributed pass over the raw bytes: a byte order mark decides, else a
file that is valid UTF-8 throughout is UTF-8, else it is GB18030. The whole
file counts, not only its head, so a first non-ASCII byte late in a big file
is not missed. The text source hands lines over undecoded, which keeps the
pass inside the JVM and splits large files. Lines that are valid UTF-8, nearly
all of them as a rule, are dropped by a filter and reach no aggregation.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Byte order marks, longest first, and the charsets they announce.
_MARKS = {
    "0000FEFF": "UTF-32",
    "FFFE0000": "UTF-32",
    "FEFF": "UTF-16",
    "FFFE": "UTF-16",
}
# Charsets in which a line feed byte may be part of another character.
WIDE = ("UTF-16", "UTF-32")


def non_utf8_files(spark: SparkSession, paths) -> DataFrame:
    """``(path, charset)`` for the files under ``paths`` that are not UTF-8."""
    head = F.hex(F.substring(F.col("value").cast("binary"), 1, 4))
    mark = F.lit(0)
    for i, bytes_of in reversed(list(enumerate(_MARKS, start=1))):
        mark = F.when(head.startswith(bytes_of), F.lit(i)).otherwise(mark)
    lines = (
        spark.read.format("text")
        .load(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
        )
        .where(~F.is_valid_utf8("value"))
    )
    at_start = F.col("block_start") == 0
    # Numbers only in the aggregation buffer, so that rows are hashed and not sorted.
    files = lines.groupBy("path").agg(
        F.min_by(F.when(at_start, mark), F.when(at_start, F.col("seq"))).alias("mark")
    )
    charset = F.lit("GB18030")
    for i, name in enumerate(_MARKS.values(), start=1):
        charset = F.when(F.col("mark") == i, F.lit(name)).otherwise(charset)
    return files.select("path", charset.alias("charset"))


def _literal_path(uri: str) -> str:
    """A file's URI as a path that a reader takes by the letter, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def paths_by_charset(spark: SparkSession, paths) -> dict[str, list[str]]:
    """Group a dataset's files for one read per charset.

    A UTF-8 dataset, the normal case, is read by its own path. Otherwise file
    names are listed, the same names Spark's file index holds on the driver
    for any scan.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    foreign = {r["path"]: r["charset"] for r in non_utf8_files(spark, roots).collect()}
    if not foreign:
        return {"UTF-8": roots}
    listing = spark.read.format("binaryFile").load(roots).where(F.col("length") > 0)
    groups: dict[str, list[str]] = {}
    for (path,) in listing.select("_metadata.file_path").collect():
        groups.setdefault(foreign.get(path, "UTF-8"), []).append(_literal_path(path))
    return {charset: sorted(files) for charset, files in sorted(groups.items())}
