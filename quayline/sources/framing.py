"""Records of delimited text files, found in byte ranges that separate tasks read.

A line break ends a record unless it lies in a quoted field, which a range in the middle of a
file cannot know. So every range first says what it would do to the parser's state for each state
it may begin in: in which state it ends and where the first record ends. These effects are composed
along the file, first within groups of ranges, then over the groups, and the state every range
begins in follows. A record belongs to the range it begins in; its task reads on to the record's
end, however far that is.

Ranges begin at whole characters. Two- and four-byte charsets have even places, and of a
surrogate pair no half looks like a mark. In GB18030 bytes below 0x30 are never part of another
character, so a range begins behind the first of these.

The states and their moves are those of Spark's CSV parser: quotes count at the start of a field
only, an escape takes the next character with it, and after a closing quote anything up to the
separator belongs to the field.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.session import staged
from quayline.sources.binary import open_filesystem

RANGE_BYTES = 32 * 1024 * 1024
# Bytes of a file whose ranges' effects one step of the composition takes: a thousand ranges as a rule.
GROUP_BYTES = 1024 * RANGE_BYTES
# Bytes in which the first line break is looked for, and rows of text that are handed over together.
HEAD, BATCH_BYTES = 1 << 20, 8 << 20

# States: at the start of a record, at the start of a field, in a plain field,
# in a quoted one, behind an escape in it, behind a quote in it that may close it.
RECORD, FIELD, PLAIN, QUOTED, ESCAPED, CLOSED = STATES = range(6)

# Byte order marks with charset and width, longest first.
_MARKS = [
    (b"\x00\x00\xfe\xff", "utf-32-be", 4),
    (b"\xff\xfe\x00\x00", "utf-32-le", 4),
    (b"\xef\xbb\xbf", "utf-8", 1),
    (b"\xfe\xff", "utf-16-be", 2),
    (b"\xff\xfe", "utf-16-le", 2),
]
# Charsets whose characters are one byte or keep to bytes beyond ASCII, and multi-byte ones that do not.
_PLAIN = re.compile(r"utf-?8|us-ascii|ascii|iso-?8859-\d+|windows-125\d|cp125\d", re.I)
_WIDE = re.compile(r"utf-?(16|32)-?(le|be)?", re.I)
_CHINESE = re.compile(r"gb18030|gbk|gb2312", re.I)
_MULTI_BYTE = re.compile(rb"[\x81-\xfe](?:[\x40-\x7e\x80-\xfe]|[\x30-\x39][\x81-\xfe][\x30-\x39])")
_COMPRESSED = r"(?i)\.(gz|bz2|zst|zstd|lz4|lzo|snappy|deflate|xz)$"


@dataclass(frozen=True)
class Dialect:
    """Marks of a delimited text, and whether quoted fields may hold line breaks."""

    sep: str = ","
    quote: str = '"'
    escape: str = "\\"
    quoted: bool = True

    def fits(self, encoding: str) -> bool:
        """Whether ranges can be read: single ASCII marks in a charset whose characters can be told apart."""
        marks = (self.sep, self.quote, self.escape)
        ascii_marks = all(len(m) == 1 and " " < m < "\x7f" or m == "\t" for m in marks)
        known = _PLAIN.fullmatch(encoding) or _WIDE.fullmatch(encoding) or _CHINESE.fullmatch(encoding)
        # Digits and letters may be the second byte of a Chinese character, lone bytes below 0x30 may not.
        return bool(ascii_marks and known)


class Framer:
    """Finds records in text that is given with a byte for each character unit."""

    def __init__(self, dialect: Dialect, lone_cr: bool = False):
        sep, quote, escape = (re.escape(m.encode()) for m in (dialect.sep, dialect.quote, dialect.escape))
        end = rb"\r\n" if lone_cr or not dialect.quoted else rb"\n"
        self.same = dialect.quote == dialect.escape
        self.quote, self.escape, self.quoted = dialect.quote.encode(), dialect.escape.encode(), dialect.quoted
        if not self.quoted:
            rest, tail = rb"[%b]" % end, rb"[^%b]*+" % end
            starts = dict.fromkeys(STATES, tail + rest)
            record, fields, body = tail + rest, b"", b""
        else:
            if self.same:
                body = rb"[^%b]*+(?:%b%b[^%b]*+)*+" % (quote, quote, quote, quote)
            else:
                body = rb"[^%b%b]*+(?:%b[\s\S][^%b%b]*+)*+" % (quote, escape, escape, quote, escape)
            tail = rb"[^%b%b]*+" % (sep, end)
            closed = body + quote + tail
            field = rb"(?:%b%b|(?!%b)%b)" % (quote, closed, quote, tail)
            rest = rb"(?:%b%b)*+[%b]" % (sep, field, end)
            # Most records of most files have no quote at all.
            bare = rb"[^%b%b]*+[%b]" % (quote, end, end)
            record, fields = rb"(?:%b|%b%b)" % (bare, field, rest), rb"(?:%b%b)*+" % (field, sep)
            again = rb"(?:%b%b|(?!%b)%b)" % (quote, closed, quote, tail) if self.same else tail
            starts = {RECORD: record, FIELD: record, PLAIN: tail + rest, QUOTED: closed + rest, ESCAPED: rb"[\s\S]" + closed + rest, CLOSED: again + rest}
        self.starts = {s: re.compile(p) for s, p in starts.items()}
        self.record, self.records = re.compile(record), re.compile(rb"(?:%b)*+" % record)
        self.breaks, self.break_bytes = re.compile(rb"[%b]" % end), b"\r\n" if rb"\r" in end else b"\n"
        self.body, self.tail, self.fields = re.compile(body), re.compile(tail), re.compile(fields)

    def state_at_end(self, text: bytes, at: int, state: int) -> int:
        """The state behind ``text[at:]``, in which no record ends."""
        end = len(text)
        if at == end:
            return state
        if not self.quoted:
            return PLAIN
        if state == ESCAPED:
            at, state = at + 1, QUOTED
        elif state == CLOSED:
            again = self.same and text[at : at + 1] == self.quote
            at, state = (at + 1, QUOTED) if again else (at, PLAIN)
        if state == QUOTED:
            at = self.body.match(text, at).end()
            if at == end:
                return QUOTED
            if not self.same and text[at : at + 1] == self.escape:
                return ESCAPED
            at, state = at + 1, PLAIN
            if at == end:
                return CLOSED
        if state == PLAIN:
            at = self.tail.match(text, at).end()
            if at == end:
                return PLAIN
            at += 1
            state = FIELD
        whole = self.fields.match(text, at).end()
        if whole > at:
            at, state = whole, FIELD
        if at == end:
            return state
        if text[at : at + 1] == self.quote:
            return self.state_at_end(text, at + 1, QUOTED) if at + 1 < end else QUOTED
        return PLAIN

    def bare(self, text: bytes) -> bool:
        """Whether every line break ends a record, where the text begins outside of a quoted field."""
        return not self.quoted or self.quote not in text

    def effect(self, text: bytes) -> tuple[list[int], list[int]]:
        """For each state: the state behind the text, and where the first record in it ends, -1 if none does."""
        first = self.breaks.search(text)
        if first and self.bare(text):
            # Without a quote every line break outside of a quoted field is a record's end.
            last = max(text.rfind(self.break_bytes[i : i + 1]) for i in range(len(self.break_bytes)))
            end = self.state_at_end(text, last + 1, RECORD)
            inside = [self.state_at_end(text, 0, s) for s in (QUOTED, ESCAPED)] if self.quoted else [end, end]
            at = [first.end(), -1] if self.quoted else [first.end()] * 2
            return [end, end, end, *inside, end], [at[0], at[0], at[0], at[1], at[1], at[0]]
        ends, firsts = [], []
        met: dict[int, int] = {}
        for state in STATES:
            found = self.starts[state].match(text)
            if not found:
                ends.append(self.state_at_end(text, 0, state))
                firsts.append(-1)
                continue
            at = found.end()
            firsts.append(at)
            # From where another run has been before, all runs are alike.
            passed = []
            for _ in range(4096):
                if at in met:
                    break
                passed.append(at)
                found = self.record.match(text, at)
                if not found:
                    break
                at = found.end()
            if at in met:
                last = met[at]
            else:
                at = self.records.match(text, at).end()
                last = RECORD if at == len(text) else self.state_at_end(text, at, RECORD)
            met.update(dict.fromkeys(passed, last))
            ends.append(last)
        return ends, firsts


class RangeReader:
    """A text file opened by a task."""

    def __init__(self, stream, size: int, encoding: str, dialect: Dialect):
        self.stream, self.size = stream, size
        head = stream.read_at(min(size, 4), 0)
        self.encoding, self.width, self.begin = encoding, 1, 0
        wide = _WIDE.fullmatch(encoding)
        if wide:
            self.width = int(wide[1]) // 8
            self.encoding = f"utf-{wide[1]}-{(wide[2] or 'be').lower()}"
        for mark, name, width in _MARKS:
            ours = name.startswith(self.encoding) if wide and wide[2] else width == self.width
            if head.startswith(mark) and ours and (wide or re.fullmatch("utf-?8", encoding, re.I)):
                self.begin, self.encoding = len(mark), name
                break
        self.chinese = bool(_CHINESE.fullmatch(encoding))
        first = re.search(rb"[\r\n]", start := self.units(stream.read_at(min(size - self.begin, HEAD * self.width), self.begin)))
        self.break_ = start[first.start() : first.start() + 2] if first else b"\n"
        self.framer = Framer(dialect, lone_cr=self.break_[:1] == b"\r" and self.break_ != b"\r\n")
        self.strip_cr = self.break_ == b"\r\n"

    def units(self, data: bytes) -> bytes:
        """A byte for each character unit; what is no ASCII becomes a byte beyond it."""
        if self.chinese:
            return _MULTI_BYTE.sub(lambda m: b"\x80" * len(m[0]), data)
        if self.width == 1:
            return data
        import numpy as np

        kind = f"{'<' if self.encoding.endswith('le') else '>'}u{self.width}"
        wide = np.frombuffer(data[: len(data) // self.width * self.width], dtype=kind)
        return np.where(wide < 128, wide, 128).astype(np.uint8).tobytes()

    def aligned(self, at: int) -> int:
        """The first place from ``at`` on where a character surely begins."""
        if at <= self.begin:
            return self.begin
        if at >= self.size:
            return self.size
        if not self.chinese:
            return min(self.size, at + -(at - self.begin) % self.width)
        at -= 1
        while at < self.size:
            found = re.search(rb"[\x00-\x2f]", self.stream.read_at(min(1 << 16, self.size - at), at))
            if found:
                return at + found.end()
            at += 1 << 16
        return self.size

    def read(self, start: int, stop: int) -> bytes:
        return self.stream.read_at(stop - start, start) if stop > start else b""

    def records(self, start: int, stop: int, first: int) -> Iterator[bytes]:
        """The records that begin from ``start`` on and before ``stop``; the first begins at unit ``first``."""
        if first < 0 or start >= stop:
            return
        data = self.read(start, stop)
        text, width, at = self.units(data), self.width, first
        match = self.framer.record.match
        if self.framer.bare(text):
            for found in self.framer.breaks.finditer(text, at):
                yield self.content(data, text, at, found.end() - 1)
                at = found.end()
        while at < len(text):
            found = match(text, at)
            if not found:
                break
            yield self.content(data, text, at, found.end() - 1)
            at = found.end()
        if at >= len(text):
            return
        # The last record goes on behind the range.
        data, step = data[at * width :], 1 << 16
        while stop < self.size:
            more = self.read(stop, min(self.size, stop + step))
            stop, step = stop + len(more), 2 * step
            data += more
            text = self.units(data)
            found = match(text)
            if found:
                yield self.content(data, text, 0, found.end() - 1)
                return
        yield self.content(data, text := self.units(data), 0, len(text))

    def content(self, data: bytes, text: bytes, start: int, stop: int) -> bytes:
        if self.strip_cr and stop > start and text[stop - 1] == 13 and stop < len(text):
            stop -= 1
        return data[start * self.width : stop * self.width]


def _readers(options: dict, encoding: str, dialect: Dialect):
    """Opens files, keeping the last one open for the next range."""
    held: dict = {}

    def reader(path: str) -> RangeReader:
        if path not in held:
            held.clear()
            fs, name = open_filesystem(path, options)
            stream = fs.open_input_file(name)
            held[path] = RangeReader(stream, stream.size(), encoding, dialect)
        return held[path]

    return reader


_EFFECTS = "path string, split int, start bigint, stop bigint, ends array<int>, firsts array<bigint>"


def _effects(options: dict, encoding: str, dialect: Dialect):
    def run(batches):
        import pyarrow as pa

        reader = _readers(options, encoding, dialect)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                file = reader(row["path"])
                start, stop = file.aligned(row["start"]), file.aligned(row["stop"])
                out.append((row["path"], row["split"], start, stop, *file.framer.effect(file.units(file.read(start, stop)))))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "split", "start", "stop", "ends", "firsts"])

    return run


# Ranges without a character begin where the next one does, and come before it.
_ORDER = [("start", "ascending"), ("stop", "ascending")]


def _composed(rows):
    """The effect of a group of neighbouring ranges."""
    import pyarrow as pa

    states = list(STATES)
    for ends in rows.sort_by(_ORDER).column("ends").to_pylist():
        states = [ends[s] for s in states]
    at = [[rows.column("path")[0].as_py()], [rows.column("part")[0].as_py()], [states]]
    return pa.table([pa.array(v, k) for v, k in zip(at, (pa.string(), pa.int64(), pa.list_(pa.int32())))], names=["path", "part", "ends"])


def _groups_begin(rows):
    """The state every group of a file begins in."""
    import pyarrow as pa

    rows, state, out = rows.sort_by("part"), RECORD, []
    for ends in rows.column("ends").to_pylist():
        out.append(state)
        state = ends[state]
    return pa.table([rows.column("path"), rows.column("part"), pa.array(out, pa.int32())], names=["path", "part", "begin"])


def _ranges_begin(rows):
    """Where the first record that begins in each range of a group does so, -1 if none does."""
    import pyarrow as pa

    rows = rows.sort_by(_ORDER)
    state, out = rows.column("begin")[0].as_py(), []
    for ends, firsts in zip(rows.column("ends").to_pylist(), rows.column("firsts").to_pylist()):
        out.append(0 if state == RECORD else firsts[state])
        state = ends[state]
    names = ["path", "split", "start", "stop"]
    return pa.table([*map(rows.column, names), pa.array(out, pa.int64())], names=[*names, "first"])


def _records(options: dict, encoding: str, dialect: Dialect):
    def run(batches):
        import pyarrow as pa

        reader = _readers(options, encoding, dialect)
        blank = bytes(range(33))
        for batch in batches:
            for row in batch.to_pylist():
                file, held, size = reader(row["path"]), [], 0
                first = row["start"] == file.begin
                for record in file.records(row["start"], row["stop"], row["first"]):
                    # As the parser does: empty lines go, of plain lines also those of white space alone.
                    if not record or not dialect.quoted and not record.strip(blank):
                        continue
                    held.append(record if file.encoding.startswith("utf-8") else record.decode(file.encoding, "replace").encode())
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield _batch(pa, held, first)
                        held, size, first = [], 0, False
                if held:
                    yield _batch(pa, held, first)

    return run


def _batch(pa, records: list[bytes], first: bool):
    heads = [first] + [False] * (len(records) - 1)
    return pa.RecordBatch.from_arrays([pa.array(records, pa.binary()), pa.array(heads)], ["record", "head"])


def listed(spark: SparkSession, paths, recursive: bool = False) -> DataFrame:
    """``(path, length)`` of the files under ``paths`` that hold a byte; none is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(paths)
    return found.where(F.col("length") > 0).select("path", "length")


def uncompressed(files: DataFrame) -> DataFrame:
    """``files``, refusing compressed ones when they are read: these have no ranges."""
    message = F.concat(F.lit("a compressed file cannot be read in ranges: "), F.col("path"))
    return files.where(~F.col("path").rlike(_COMPRESSED) | F.raise_error(message).cast("boolean"))


def rangeable(files: DataFrame, range_bytes: int = RANGE_BYTES) -> bool:
    """Whether a file is longer than a range, and none is compressed."""
    seen = files.agg(F.max("length").alias("longest"), F.count_if(F.col("path").rlike(_COMPRESSED)).alias("compressed")).first()
    return bool(seen["longest"]) and seen["longest"] > range_bytes and not seen["compressed"]


def cut_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, split, start, stop)``: the files in ranges of equal length, but for the last of each."""
    whole = files.select("path", F.lit(0).alias("split"), F.lit(0).cast("bigint").alias("start"), F.col("length").alias("stop"))
    return cut_pieces(whole, range_bytes)


def cut_pieces(pieces: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pieces of files ``(path, split, start, stop)`` cut further, so that none is longer than ``range_bytes``."""
    if range_bytes <= 0:
        raise InvalidParameterError(f"ranges must have a positive number of bytes, not {range_bytes}")
    last = F.ceil((F.col("stop") - F.col("start")) / range_bytes).cast("bigint") - 1
    rows = pieces.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("no"))
    start = F.col("start") + F.col("no") * range_bytes
    return rows.select("path", "split", start.alias("start"), F.least(F.col("stop"), start + range_bytes).alias("stop"))


def frame(ranges: DataFrame, encoding: str, dialect: Dialect, options: dict) -> DataFrame:
    """``(path, split, start, stop, first)``: the ranges from whole characters on, and where their records begin.

    One pass over the bytes; what is composed is one small row for each range.
    """
    spark = ranges.sparkSession
    effects = staged(spark, spread(ranges).mapInArrow(_effects(options, encoding, dialect), _EFFECTS), "effects")
    parts = effects.withColumn("part", F.floor(F.col("start") / GROUP_BYTES).cast("bigint"))
    joined = parts.groupBy("path", "part").applyInArrow(_composed, "path string, part bigint, ends array<int>")
    begin = joined.groupBy("path").applyInArrow(_groups_begin, "path string, part bigint, begin int")
    placed = parts.join(begin, ["path", "part"]).groupBy("path", "part")
    framed = placed.applyInArrow(_ranges_begin, "path string, split int, start bigint, stop bigint, first bigint")
    return staged(spark, framed, "framed")


def spread(ranges: DataFrame) -> DataFrame:
    """Ranges dealt to tasks: rows of a few bytes that stand for megabytes."""
    spark = ranges.sparkSession
    held = ranges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("stop") - F.col("start")).alias("bytes")).first()
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil((held["bytes"] or 0) / (2 * RANGE_BYTES)))
    return ranges.repartition(max(1, min(held["n"], tasks)), "path", "start")


def read_records(framed: DataFrame, encoding: str, dialect: Dialect, options: dict) -> DataFrame:
    """``(record, head)``: every record as text without its line break, and whether it is its file's first."""
    found = framed.select("path", "start", "stop", "first").mapInArrow(_records(options, encoding, dialect), "record binary, head boolean")
    return found.select(F.col("record").cast("string").alias("record"), "head")
