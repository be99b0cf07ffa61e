import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline import functions as C
from quayline.errors import InvalidParameterError


FAILS = (PySparkException, Py4JJavaError)


def values(spark, inputs, fn, ddl="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_signed_limits(spark):
    assert values(spark, ["127", "-128", "+5", "", None], lambda c: C.to_signed(c, "int8")) == [127, -128, 5, None, None]
    assert values(spark, [str(2**63 - 1)], lambda c: C.to_signed(c, "int64")) == [2**63 - 1]


@pytest.mark.parametrize("text", ["128", " 1", "1 ", "1.0", "x", "1e3", "0x1", " "])
def test_bad_integers_fail_with_column_value_and_type(spark, text):
    with pytest.raises(FAILS) as e:
        values(spark, [text], lambda c: C.to_signed(c, "int8", "age"))
    assert f"column age: value '{text}' is not int8" in str(e.value)
    assert values(spark, [text], lambda c: C.to_signed(c, "int8", on_error="null")) == [None]


@pytest.mark.parametrize("name, bits", [("uint8", 8), ("unit8", 8), ("uint16", 16), ("uint32", 32), ("uint64", 64)])
def test_unsigned_range(spark, name, bits):
    top = 2**bits - 1
    assert [int(v) for v in values(spark, ["0", str(top)], lambda c: C.to_unsigned(c, name))] == [0, top]
    for bad in (str(top + 1), "-1"):
        with pytest.raises(FAILS):
            values(spark, [bad], lambda c: C.to_unsigned(c, name))


def test_booleans(spark):
    texts = ["true", "TRUE", "False", "0", "1", "7", "", None]
    assert values(spark, texts, C.to_boolean) == [True, True, False, False, True, True, None, None]
    with pytest.raises(FAILS):
        values(spark, ["yes"], C.to_boolean)


def test_floating(spark):
    assert values(spark, ["1.5", "-0.25", "1e3", ""], lambda c: C.to_floating(c, "float64")) == [1.5, -0.25, 1000.0, None]
    with pytest.raises(FAILS):
        values(spark, ["1,5"], lambda c: C.to_floating(c, "float32"))


def test_wrong_kind_of_type():
    for fn, name in ((C.to_signed, "uint8"), (C.to_unsigned, "int8")):
        with pytest.raises(InvalidParameterError):
            fn(F.lit("1"), name)


def test_epoch_day(spark):
    assert values(spark, ["0", "19000", "-1", ""], C.epoch_day_to_date) == [
        dt.date(1970, 1, 1),
        dt.date(2022, 1, 8),
        dt.date(1969, 12, 31),
        None,
    ]
    assert values(spark, [dt.date(2022, 1, 8)], C.date_to_epoch_day, "date") == [19000]


def test_date64_keeps_the_whole_timestamp(spark):
    assert values(spark, ["2024-05-20T10:11:12.345678", "2024-05-20T10:11"], C.iso_to_date64) == [
        dt.datetime(2024, 5, 20, 10, 11, 12, 345000),
        dt.datetime(2024, 5, 20, 10, 11),
    ]
    for bad in ("20 May", "2024-05-20T10:11:12Z", "2024-05-20T10:11:12-03:00", "2024-05-20T10:11:12+01:00"):
        with pytest.raises(FAILS):
            values(spark, [bad], C.iso_to_date64)


def test_timestamps_before_epoch_floor(spark):
    ts = dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
    assert values(spark, [ts], C.ntz_to_millis, "timestamp_ntz") == [ts.replace(microsecond=999000)]


def test_decimal_rounds_up(spark):
    inputs = [Decimal("1.2341"), Decimal("-1.2341"), Decimal("1.2300"), None]
    assert values(spark, inputs, lambda c: C.rescale_decimal(c, 10, 2), "decimal(10,4)") == [
        Decimal("1.24"),
        Decimal("-1.23"),
        Decimal("1.23"),
        None,
    ]


def test_decimal_text(spark):
    texts = ["1.2341", "-1.2341", "99999.99", "1e2", "", None]
    found = values(spark, texts, lambda c: C.to_decimal(c, 7, 2))
    assert found == [Decimal("1.24"), Decimal("-1.23"), Decimal("99999.99"), Decimal("100.00"), None, None]
    for bad in ("100000", " 1", "x", "99999.991"):
        with pytest.raises(FAILS):
            values(spark, [bad], lambda c: C.to_decimal(c, 7, 2))


def test_time_units(spark):
    assert values(spark, [1234], lambda c: C.rescale_time(c, "ms", "us"), "bigint") == [1234000]
    assert values(spark, [1999], lambda c: C.rescale_time(c, "ms", "s"), "bigint") == [1]
    with pytest.raises(InvalidParameterError):
        C.rescale_time(F.lit(1), "ms", "days")


def test_epoch_ticks(spark):
    split = values(spark, [-1, 1_500], lambda c: C.split_epoch(c, "ms"), "bigint")
    assert [tuple(s) for s in split] == [(-1, 999_000_000), (1, 500_000_000)]
    shown = values(spark, [0], lambda c: C.epoch_to_timestamp(c, "s", "Asia/Shanghai").cast("string"), "bigint")
    assert shown == ["1970-01-01 08:00:00"]
    exact = values(spark, [2**62], lambda c: C.split_epoch(c, "ns"), "bigint")
    assert tuple(exact[0]) == divmod(2**62, 10**9)


def test_maps(spark):
    texts = ['{"a":1,"b":null,"c":"x"}', None]
    assert values(spark, texts, C.json_to_map) == [{"a": "1", "b": None, "c": "x"}, None]
    assert values(spark, [{"a": None, "b": "1"}], C.map_to_json, "map<string,string>") == ['{"a":null,"b":"1"}']
    with pytest.raises(FAILS):
        values(spark, ["{broken"], C.json_to_map)


def test_arrays(spark):
    assert values(spark, [[1, None, 3]], C.to_text_array, "array<int>") == [["1", None, "3"]]
    assert values(spark, [[1, None]], C.array_to_json, "array<int>") == ["[1,null]"]
    assert values(spark, ["[1,null]"], lambda c: C.json_to_array(c, T.IntegerType())) == [[1, None]]


def test_sql_literals(spark):
    assert values(spark, ["it's", "", None], lambda c: C.sql_literal(c, T.StringType())) == ["'it''s'", "''", None]
    assert values(spark, [7], lambda c: C.sql_literal(c, T.IntegerType()), "int") == ["7"]
    assert values(spark, [True], lambda c: C.sql_literal(c, T.BooleanType()), "boolean") == ["true"]
    assert values(spark, [b"a'b"], lambda c: C.sql_literal(c, T.BinaryType()), "binary") == ["'a''b'"]
    assert values(spark, [dt.date(2024, 1, 2)], lambda c: C.sql_literal(c, T.DateType()), "date") == ["'2024-01-02'"]


def test_quoting():
    assert C.quote_ident("a`b") == "`a``b`"
    assert C.quote_text("a'b\\") == "'a''b\\\\'"


def test_literals_read_back(spark):
    texts = ["it's", "back\\slash", "\\'", "line\nbreak", "汉"]
    for text, literal in zip(texts, values(spark, texts, lambda c: C.sql_literal(c, T.StringType()))):
        assert literal == C.quote_text(text)
        assert spark.sql(f"SELECT {literal}").first()[0] == text


def test_recast(spark):
    assert values(spark, ["12"], lambda c: C.recast(c, "int")) == [12]
    with pytest.raises(FAILS):
        values(spark, ["x"], lambda c: C.recast(c, "int"))


def test_text_and_bytes(spark):
    assert values(spark, ["汉é"], C.utf8_bytes) == [bytearray("汉é".encode())]
    assert values(spark, ["汉é".encode()], C.utf8_text, "binary") == ["汉é"]
