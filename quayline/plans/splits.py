"""A file dataset in a given number of even splits, one partition each.

The files of a dataset, in name order, are one long string of bytes, cut into n pieces of equal
length whatever the files' lengths are: a piece may be part of a file or many files. A split has the
records that begin in its piece (or the chunks, for bytes). Only file names and lengths are looked
at to plan this, as tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.operators.columns import project
from quayline.operators.running import running_total
from quayline.refs import FILE_KINDS, ContentType, DatasetRef, resolve
from quayline.session import configure
from quayline.sources import framing
from quayline.sources.binary import FILE_CHUNK, arrow_options, read_ranges
from quayline.sources.charset import paths_by_charset
from quayline.sources.csv import scan_ranges


def even_pieces(files: DataFrame, n: int, unit: int = 1) -> DataFrame:
    """``(path, split, start, stop)``: the bytes of ``files(path, length)`` in ``n`` splits.

    Splits differ by less than two units: cuts inside a file lie at multiples of ``unit`` of it.
    """
    if n < 1:
        raise InvalidParameterError(f"the number of splits must be positive, not {n}")
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    placed = running_total(files.select("path", F.col("length").cast("bigint").alias("length")), ["path"], "length")
    # The first ``longer`` splits have a byte more than the others.
    each, longer = divmod(total, n)
    cut = lambda k: k * F.lit(each) + F.least(k, F.lit(longer))

    def split_of(byte):
        among = f"({longer} + (at - {longer * (each + 1)}L) div {max(each, 1)}L)"
        return F.expr(f"if(at < {longer * (each + 1)}L, at div {each + 1}L, {among})".replace("at", byte)).cast("bigint")

    near = F.sequence(split_of("before"), split_of("(before + length - 1)"))
    pieces = placed.select("path", "length", "before", F.explode(near).alias("split"))

    def inside(k):
        offset = F.greatest(cut(k) - F.col("before"), F.lit(0))
        return F.least(F.col("length"), offset + F.pmod(-offset, F.lit(unit)))

    pieces = pieces.select("path", F.col("split").cast("int").alias("split"), inside(F.col("split")).alias("start"), inside(F.col("split") + 1).alias("stop"))
    return pieces.where("start < stop")


def read_splits(
    spark: SparkSession,
    ref: DatasetRef,
    n: int,
    columns=None,
    content_type: str = "table",
    multiline: bool = False,
    ragged: str = "fail",
    range_bytes: int = framing.RANGE_BYTES,
    chunk_bytes: int = FILE_CHUNK,
) -> DataFrame:
    """A file dataset as a DataFrame of exactly ``n`` partitions of equal bytes.

    CSV splits are cut at bytes and begin with whole records, those of bytes at whole chunks. ORC and
    Parquet hold whole stripes of rows; they are read as ever and dealt out by rows, in one shuffle.
    """
    configure(spark)
    if ref.source.storage not in FILE_KINDS:
        raise InvalidParameterError("only a file dataset is read in splits; a database table has its pages")
    if n < 1:
        raise InvalidParameterError(f"the number of splits must be positive, not {n}")
    content = ContentType(content_type)
    spec = resolve(ref, content_type)
    ref.source.apply(spark)
    stores = arrow_options(spark, spec.location)
    if stores is None:
        raise InvalidParameterError(f"files of {spec.location} cannot be read in ranges")
    if spec.reader == "binary" or content is ContentType.RAW:
        files = framing.listed(spark, spec.location, recursive=True)
        pieces = even_pieces(files, n, chunk_bytes)
        return project(read_ranges(by_split(pieces, n), chunk_bytes, stores), columns)
    if spec.reader != "csv":
        return project(spark.read.format(spec.reader).load(spec.location), columns).repartition(n)
    encoding = ref.csv.encoding
    groups = {encoding: [spec.location]} if encoding else paths_by_charset(spark, [spec.location])
    if len(groups) > 1:
        raise InvalidParameterError(f"files in {sorted(groups)} are no one dataset of even splits: declare the encoding")
    charset, paths = next(iter(groups.items()))
    pieces = even_pieces(framing.uncompressed(framing.listed(spark, paths)), n)
    ranges = framing.cut_pieces(pieces, range_bytes)
    return scan_ranges(spark, paths, ranges, charset, ref.columns, columns, ref.csv, ragged, multiline, lambda framed: by_split(framed, n))


def by_split(pieces: DataFrame, n: int) -> DataFrame:
    """Every split in the partition of its number, in order."""
    return pieces.repartitionById(n, F.col("split")).sortWithinPartitions("path", "start")
