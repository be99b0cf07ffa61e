import itertools
import os
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import HeaderMissingError, InvalidParameterError, MissingFieldError
from quayline.refs import CsvFormat
from quayline.sinks.csv import refuse_special, render_csv, write_csv
from quayline.sources.charset import non_utf8_files, paths_by_charset
from quayline.sources.csv import bad_values, infer_csv_schema, read_csv


FAILS = (PySparkException, Py4JJavaError)


def put(folder, name, data, encoding="utf-8"):
    path = folder / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode(encoding))
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_any_text_survives(spark, tmp_path):
    marks = ["a", '"', "\\", ",", "'", " ", "\t", "\n", "\r", "\0", "#", "é", "汉", "\u2028"]
    texts = ["".join(c) for n in range(4) for c in itertools.product(marks, repeat=n)]
    other = random.Random(1).sample(texts, len(texts))
    df = spark.createDataFrame(list(zip(texts, other, range(len(texts)))), "a string, b string, id int").repartition(4)
    for fmt in (CsvFormat(), CsvFormat(separator="\t", quote="'")):
        path = str(tmp_path / f"t{ord(fmt.separator)}")
        write_csv(df, path, fmt)
        back = read_csv(spark, path, df.schema, fmt=fmt, multiline=True)
        want = df.select(*[F.nullif(c, F.lit("")).alias(c) for c in ("a", "b")], "id")
        assert back.count() == len(texts)
        assert back.exceptAll(want).count() == 0


def test_projection_any_subset_and_order(spark, tmp_path):
    path = put(tmp_path, "f.csv", "x,y,z\n1,2,3\n4,5,6\n")
    assert rows(read_csv(spark, path, {"z": "int64"})) == [(3,), (6,)]
    assert read_csv(spark, path, {"z": "int64", "x": "int8"}).columns == ["z", "x"]
    assert read_csv(spark, path, select=["y", "x"]).columns == ["y", "x"]
    with pytest.raises(MissingFieldError):
        read_csv(spark, path, {"a": "int64"})
    with pytest.raises(MissingFieldError):
        read_csv(spark, path, select=["a"])


def test_files_with_other_header_order_fail(spark, tmp_path):
    put(tmp_path, "a.csv", "x,y\n1,2\n")
    put(tmp_path, "b.csv", "y,x\n3,4\n")
    with pytest.raises(FAILS):
        read_csv(spark, str(tmp_path), {"x": "int64"}).collect()


def test_charset_is_decided_by_the_whole_file(spark, tmp_path):
    filler = "k,v\n" + "1,plain\n" * 500_000
    path = put(tmp_path, "late.csv", (filler + "2,汉字\n").encode("gb18030"))
    assert rows(read_csv(spark, path, {"k": "int32", "v": "string"}).where("k = 2")) == [(2, "汉字")]


def test_mixed_charsets_and_an_empty_file(spark, tmp_path):
    put(tmp_path, "a [b] {c}%20.csv", "名,v\n汉,1\n", "gb18030")
    put(tmp_path, "u.csv", "名,v\né,2\n")
    put(tmp_path, "w.csv", "\ufeff名,v\n字,3\n", "utf-16-le")
    put(tmp_path, "empty.csv", "")
    groups = paths_by_charset(spark, str(tmp_path))
    assert {c: len(f) for c, f in groups.items()} == {"GB18030": 1, "UTF-16": 1, "UTF-8": 1}
    assert non_utf8_files(spark, str(tmp_path)).count() == 2
    found = rows(read_csv(spark, str(tmp_path), {"名": "string", "v": "int32"}))
    assert found == sorted([("汉", 1), ("é", 2), ("字", 3)], key=repr)


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"])
def test_byte_order_marks(spark, tmp_path, encoding):
    path = put(tmp_path, "b.csv", "\ufeffa,b\n1,汉\n", encoding)
    assert rows(read_csv(spark, path, {"a": "int32", "b": "string"})) == [(1, "汉")]


def test_line_framing(spark, tmp_path):
    path = put(tmp_path, "f.csv", "a,b\r\n1,x\r\n\r\n2,y")
    assert rows(read_csv(spark, path, {"a": "int32", "b": "string"})) == [(1, "x"), (2, "y")]


def test_ragged_rows(spark, tmp_path):
    declared = {"a": "int32", "b": "string", "c": "int64"}
    path = put(tmp_path, "f.csv", 'a,b,c\n1\n2,"x,\\",y"\n3,y,4\n,\n')
    for columns in (declared, {"a": "int32"}):
        with pytest.raises(FAILS, match="does not have 3 fields: 1"):
            read_csv(spark, path, columns).collect()
    padded = read_csv(spark, path, declared, ragged="pad")
    assert sorted(rows(padded), key=str) == [(1, None, None), (2, 'x,",y', None), (3, "y", 4), (None, None, None)]
    assert padded.count() == 4
    trimmed = read_csv(spark, put(tmp_path, "t.csv", "a,b,c\n1,x,2,beyond\n2\n"), declared, ragged="trim")
    assert sorted(rows(trimmed)) == [(1, "x", 2), (2, None, None)]
    for long in ("1,x,2,beyond", "1,x,2,", '1,"x,",2,3'):
        for columns in (declared, {"b": "string"}):
            with pytest.raises(FAILS, match="more than 3 fields: 1"):
                read_csv(spark, put(tmp_path, "l.csv", f"a,b,c\n{long}\n"), columns, ragged="pad").collect()
    with pytest.raises(InvalidParameterError):
        read_csv(spark, path, declared, ragged="maybe")


def test_padding_is_strict_about_values(spark, tmp_path):
    path = put(tmp_path, "f.csv", "a,b,d,u\n1,x\nfoo,y,1,2\n")
    declared = {"a": "int64", "b": "string", "d": "date32", "u": "uint8"}
    with pytest.raises(FAILS, match="column a: value 'foo' is not int64"):
        read_csv(spark, path, declared, ragged="pad").collect()
    for bad, name in (("1,x,y,2", "d"), ("1,x,2,256", "u")):
        with pytest.raises(FAILS, match=f"column {name}: value"):
            read_csv(spark, put(tmp_path, "g.csv", f"a,b,d,u\n{bad}\n"), declared, ragged="pad").collect()


def test_errors_name_column_value_and_type(spark, tmp_path):
    path = put(tmp_path, "f.csv", "a,b,c,d\n1,2,x,3.5\n4,foo,y,6\n")
    declared = {"a": "int32", "b": "int64", "c": "string", "d": "float64"}
    for columns in (declared, {"b": "int64"}):
        with pytest.raises(FAILS, match="column b: value 'foo' is not int64"):
            read_csv(spark, path, columns).collect()
    with pytest.raises(FAILS, match="column c: value 'x' is not int32"):
        read_csv(spark, path, {"c": "int32"}).collect()
    with pytest.raises(FAILS, match="column d: value '3.5' is not int8"):
        read_csv(spark, path, {"d": "int8"}).collect()


def test_declared_encoding_needs_no_look_at_the_bytes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "g")
    write_csv(spark.createDataFrame([("汉",)], "a string"), path, CsvFormat(encoding="GB18030"))
    monkeypatch.setattr("quayline.sources.csv.paths_by_charset", None)
    assert rows(read_csv(spark, path, fmt=CsvFormat(encoding="GB18030"))) == [("汉",)]


def test_inference_looks_at_every_charset(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_bytes("a,b\n1,2\n".encode())
    (folder / "b.csv").write_bytes("a,c\n1,汉\n".encode("gb18030"))
    with pytest.raises(MissingFieldError):
        infer_csv_schema(spark, str(folder))


def test_typed_values(spark, tmp_path):
    path = put(
        tmp_path,
        "f.csv",
        "i,u,f,b,d,t,s,x\n127,255,1.5,TRUE,19000,2024-05-20T10:11:12.345678, a ,é\n,,,,,,,\n",
    )
    declared = dict(i="int8", u="uint8", f="float64", b="bool", d="date32", t="date64", s="string", x="binary")
    first, second = read_csv(spark, path, declared).orderBy(F.col("i").isNull()).collect()
    assert (first.i, first.u, first.f, first.b, str(first.d)) == (127, 255, 1.5, True, "2022-01-08")
    assert first.t.microsecond == 345000 and first.t.minute == 11
    assert first.s == " a " and bytes(first.x) == "é".encode()
    assert all(v is None for v in second)


@pytest.mark.parametrize(
    "text, kind",
    [
        ("128", "int8"),
        (" 1 ", "int32"),
        ("256", "uint8"),
        ("yes", "bool"),
        ("x", "float32"),
        ("1,5", "decimal(9,2)"),
        ("12345678.9", "decimal(9,2)"),
        ("2024-05-20T10:11:12+08:00", "timestamp"),
    ],
)
def test_bad_value_stops(spark, tmp_path, text, kind):
    path = put(tmp_path, "f.csv", f'v,w\n"{text}",1\n')
    with pytest.raises(FAILS):
        read_csv(spark, path, {"v": kind}).collect()
    found = bad_values(read_csv(spark, path), {"v": kind, "w": "int32"})
    assert rows(found) == [("v", text, kind)]


def test_quotes(spark, tmp_path):
    path = put(tmp_path, "f.csv", 'a,b\n"x\\"y",1\n"p,q",2\n')
    assert rows(read_csv(spark, path, {"a": "string"})) == [("p,q",), ('x"y',)]
    doubled = put(tmp_path, "d.csv", 'a,b\n"x""y",1\n')
    assert rows(read_csv(spark, doubled, {"a": "string"}, fmt=CsvFormat(escape='"'))) == [('x"y',)]


def test_header_rules(spark, tmp_path):
    with pytest.raises(HeaderMissingError):
        read_csv(spark, put(tmp_path, "e.csv", ""))
    with pytest.raises(HeaderMissingError):
        read_csv(spark, put(tmp_path, "b.csv", "\n  \n"))
    path = put(tmp_path, "n.csv", "1,2\n3,4\n")
    assert rows(read_csv(spark, path, {"_c1": "int32"}, fmt=CsvFormat(header=False))) == [(2,), (4,)]


def test_infer_and_rename(spark, tmp_path):
    path = put(tmp_path, "f.csv", "a,b\n1,2\n")
    schema = infer_csv_schema(spark, path, CsvFormat(field_map={"a": "x"}))
    assert schema == T.StructType.fromDDL("x string, b string")
    assert rows(read_csv(spark, path, {"x": "int32"}, fmt=CsvFormat(field_map={"a": "x"}))) == [(1,)]


def test_field_map_is_undone_on_write(spark, tmp_path):
    fmt = CsvFormat(field_map={"raw": "view"})
    path = str(tmp_path / "o")
    write_csv(spark.createDataFrame([(1, 2)], "view int, b int"), path, fmt)
    assert infer_csv_schema(spark, path).names == ["raw", "b"]
    assert rows(read_csv(spark, path, {"view": "int32"}, fmt=fmt)) == [(1,)]


def test_single_column_keeps_null_and_blank_rows(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("",), ("  ",)], "a string")
    path = str(tmp_path / "o")
    write_csv(df, path)
    assert rows(read_csv(spark, path)) == sorted([("a",), (None,), (None,), ("  ",)], key=repr)


def test_empty_frame_leaves_a_header(spark, tmp_path):
    path = str(tmp_path / "o")
    write_csv(spark.createDataFrame([], "a int, b string"), path)
    back = read_csv(spark, path)
    assert back.columns == ["a", "b"] and back.count() == 0


def test_nested_values_are_json_text(spark, tmp_path):
    df = spark.sql("""SELECT map('k', CAST(NULL AS STRING)) AS m, array(1, NULL) AS a,
                             named_struct('x', 1, 'y', 'p,q') AS s, CAST(1.25 AS DECIMAL(9, 2)) AS d""")
    path = str(tmp_path / "o")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema)
    assert [f.dataType.simpleString() for f in back.schema] == [f.dataType.simpleString() for f in df.schema]
    assert back.first() == df.first()


def test_options(spark, tmp_path):
    df = spark.createDataFrame([("p,q",)], "a string")
    with pytest.raises(FAILS):
        refuse_special(df, CsvFormat()).collect()
    with pytest.raises(InvalidParameterError):
        write_csv(df, str(tmp_path / "x"), quoting="all")
    with pytest.raises(InvalidParameterError):
        write_csv(df, str(tmp_path / "x"), dates="us")
    with pytest.raises(InvalidParameterError):
        write_csv(df, str(tmp_path / "x"), single_file=True, encoding="UTF-16")


def test_single_file_keeps_the_row_order(spark, tmp_path):
    df = spark.range(10_000).select("id", F.lit("汉,字").alias("a,b")).repartitionByRange(5, "id")
    for encoding in (None, "GB18030"):
        path = tmp_path / f"one{encoding}"
        write_csv(df, str(path), single_file=True, encoding=encoding)
        assert os.listdir(path) == ["data.csv"]
        lines = (path / "data.csv").read_text(encoding or "utf-8").splitlines()
        assert lines == ['id,"a,b"'] + [f'{i},"汉,字"' for i in range(10_000)]
    write_csv(df.where("id < 0"), str(tmp_path / "none"), single_file=True)
    assert (tmp_path / "none" / "data.csv").read_text() == 'id,"a,b"\n'


def test_render(spark):
    df = spark.createDataFrame([(1, "p,q", None, b"x")], "a int, b string, c int, d binary")
    assert render_csv(df).first().line == '1,"p,q",,x'


def test_plan_is_one_scan_without_shuffle(spark, tmp_path):
    path = put(tmp_path, "f.csv", "x,y\n1,2\n")
    plan = read_csv(spark, path, {"y": "int64", "x": "bool"})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
