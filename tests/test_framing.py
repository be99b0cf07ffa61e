"""Ranges of text files against a plain walk through the bytes, and against Spark's own reader in one task."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quayline.refs import CsvFormat
from quayline.sinks.csv import write_csv
from quayline.sources import framing
from quayline.sources.csv import read_csv
from quayline.sources.framing import CLOSED, ESCAPED, FIELD, PLAIN, QUOTED, RECORD, Dialect, RangeReader
from tests.test_csv import put, rows


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def plain_records(text, d):
    """The records of a text, a byte at a time."""
    sep, quote, escape = (ord(m) for m in (d.sep, d.quote, d.escape))
    found, state, held = [], RECORD, bytearray()
    for c in text:
        if c == 10 and state not in (QUOTED, ESCAPED):
            found.append(bytes(held))
            held.clear()
            state = RECORD
            continue
        held.append(c)
        if state == ESCAPED:
            state = QUOTED
        elif state == QUOTED:
            state = CLOSED if c == quote else ESCAPED if c == escape else QUOTED
        elif state == CLOSED and c == quote and quote == escape:
            state = QUOTED
        elif c == sep:
            state = FIELD
        else:
            state = QUOTED if c == quote and state in (RECORD, FIELD) else PLAIN
    return found + ([bytes(held)] if held else [])


def ranged_records(data, d, size, encoding="UTF-8"):
    file, state, out = RangeReader(Bytes(data), len(data), encoding, d), RECORD, []
    for at in range(0, len(data), size):
        start, stop = file.aligned(at), file.aligned(min(len(data), at + size))
        ends, firsts = file.framer.effect(file.units(file.read(start, stop)))
        out += [r.decode(file.encoding) for r in file.records(start, stop, 0 if state == RECORD else firsts[state])]
        state = ends[state]
    return out


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_ranges_find_the_records_of_any_text(escape):
    rng, d = random.Random(5), Dialect(escape=escape)
    for _ in range(6000):
        data = bytes(rng.choices(b'ab,",\n"\\\n,"x', k=rng.randint(0, 40)))
        assert ranged_records(data, d, rng.choice([4, 8, 12, 40])) == [r.decode() for r in plain_records(data, d)], data


@pytest.mark.parametrize("encoding, python", [("UTF-16", "utf-16"), ("UTF-16LE", "utf-16-le"), ("UTF-16BE", "utf-16-be"), ("UTF-32", "utf-32"), ("GB18030", "gb18030"), ("UTF-8", "utf-8-sig")])
def test_ranges_begin_at_whole_characters(encoding, python):
    # Second bytes of the Chinese ones look like a backslash, a digit, a letter.
    parts = ["a", ",", '"', "\n", "漢", "字", "€", "😀", "\\", "㐀", "é", "0", "乗", "亅", " ", "誠"]
    rng, d = random.Random(6), Dialect()
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        want = [r.decode() for r in plain_records(text.encode(), d)]
        assert ranged_records(text.encode(python), d, rng.choice([4, 8, 12, 40]), encoding) == want, text


def test_line_breaks_of_other_systems():
    d = Dialect()
    assert ranged_records(b'a,"x\r\ny"\r\nb,c\r\n\r\nd', d, 4) == ['a,"x\r\ny"', "b,c", "", "d"]
    assert ranged_records(b'a,"x\ry"\rb,c\rd', d, 4) == ['a,"x\ry"', "b,c", "d"]
    assert ranged_records(b"a\r\nb\rc\nd\r", Dialect(quoted=False), 4) == ["a", "", "b", "c", "d"]


def test_ranges_equal_one_task(spark, tmp_path):
    marks = ["a", '"', "\\", ",", "'", " ", "\t", "\n", "\r", "\0", "#", "é", "汉", "\u2028"]
    texts = ["".join(c) for n in range(4) for c in itertools.product(marks, repeat=n)]
    other = random.Random(1).sample(texts, len(texts))
    df = spark.createDataFrame(list(zip(texts, other, range(len(texts)))), "a string, b string, id int").repartition(2)
    for fmt in (CsvFormat(), CsvFormat(separator="\t", quote="'"), CsvFormat(escape='"')):
        path = str(tmp_path / f"t{ord(fmt.separator)}{ord(fmt.escape)}")
        if fmt.escape == fmt.quote:  # with these the parser itself loses some NUL characters
            df = df.where("not contains(a, '\\0') and not contains(b, '\\0')")
        write_csv(df, path, fmt)
        got = read_csv(spark, path, df.schema, fmt=fmt, multiline=True, range_bytes=1024)
        assert got.rdd.getNumPartitions() > 2 and got.count() == df.count()
        assert got.exceptAll(df.select(*[F.nullif(c, F.lit("")).alias(c) for c in ("a", "b")], "id")).count() == 0
        assert got.exceptAll(read_csv(spark, path, df.schema, fmt=fmt, multiline=True)).count() == 0


@pytest.mark.parametrize("encoding", ["UTF-16", "UTF-16LE", "UTF-32", "GB18030", "UTF-8"])
def test_charsets_in_ranges(spark, tmp_path, encoding):
    df = spark.range(400).select("id", F.concat(F.lit('汉"\n\\乗😀,'), F.repeat(F.lit("誠"), (F.col("id") % 90).cast("int"))).alias("t"))
    path = str(tmp_path / "f")
    write_csv(df.repartition(2), path, encoding=encoding)
    got = read_csv(spark, path, df.schema, encoding=encoding, multiline=True, range_bytes=4096)
    assert got.rdd.getNumPartitions() > 2 and got.count() == 400 and got.exceptAll(df).count() == 0
    # A field longer than several ranges.
    long = spark.createDataFrame([(1, "x\n" * 20_000), (2, "y"), (3, '"\n' * 9000)], df.schema)
    write_csv(long.coalesce(1), path + "2", encoding=encoding)
    got = read_csv(spark, path + "2", df.schema, encoding=encoding, multiline=True, range_bytes=4096)
    assert got.exceptAll(long).count() == 0 and got.count() == 3


def test_errors_are_those_of_one_task(spark, tmp_path):
    put(tmp_path, "a.csv", "id,t\n" + "".join(f'{i},"x\n{i}"\n' for i in range(300)))
    put(tmp_path, "b.csv", "\n\nid,t\n\n7,\n8")
    declared = {"id": "int64", "t": "string"}
    for settings in ({}, {"range_bytes": 256}):
        with pytest.raises(Exception, match="does not have 2 fields"):
            read_csv(spark, str(tmp_path), declared, encoding="UTF-8", multiline=True, **settings).collect()
        padded = read_csv(spark, str(tmp_path), declared, encoding="UTF-8", multiline=True, ragged="pad", **settings)
        assert len(rows(padded)) == 302 and (8, None) in rows(padded) and (7, None) in rows(padded)
    put(tmp_path, "b.csv", "id,t\nx,1\n")
    with pytest.raises(Exception, match="column id: value 'x' is not int64"):
        read_csv(spark, str(tmp_path), declared, encoding="UTF-8", multiline=True, range_bytes=256).collect()
    put(tmp_path, "b.csv", "id,other\n1,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), declared, encoding="UTF-8", multiline=True, range_bytes=256).collect()
    with pytest.raises(Exception, match="positive"):
        framing.cut_ranges(framing.listed(spark, str(tmp_path)), 0)


def test_composition_over_many_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(framing, "GROUP_BYTES", 200)
    put(tmp_path, "a.csv", "id,t\n" + "".join(f'{i},"{"line\n" * (i % 40)}"\n' for i in range(120)))
    got = read_csv(spark, str(tmp_path), {"id": "int64", "t": "string"}, encoding="UTF-8", multiline=True, range_bytes=64)
    assert rows(got) == sorted(((i, "line\n" * (i % 40) or None) for i in range(120)), key=repr)
