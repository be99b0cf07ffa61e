import pytest
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, UnsupportedTypeError
from quayline.types import (
    Column,
    as_columns,
    declared_name,
    declared_schema,
    jdbc_spark_type,
    mysql_type,
    spark_type,
    warehouse_type,
)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("int8", T.ByteType()),
        ("int16", T.ShortType()),
        ("int32", T.IntegerType()),
        ("int64", T.LongType()),
        ("int", T.LongType()),
        ("unit8", T.ShortType()),
        ("uint8", T.ShortType()),
        ("uint16", T.IntegerType()),
        ("uint32", T.LongType()),
        ("uint64", T.DecimalType(20, 0)),
        ("float16", T.FloatType()),
        ("float32", T.FloatType()),
        ("float64", T.DoubleType()),
        ("float", T.DoubleType()),
        ("date32", T.DateType()),
        ("date64", T.TimestampNTZType()),
        ("bool", T.BooleanType()),
        ("str", T.StringType()),
        ("string", T.StringType()),
        ("binary", T.BinaryType()),
    ],
)
def test_declared_types(name, expected):
    assert spark_type(name) == expected


@pytest.mark.parametrize("name", ["datetime", "decimal", "", "INT", "array<", "decimal(x)"])
def test_unknown_declared_type(name):
    with pytest.raises(InvalidParameterError):
        spark_type(name)


def test_declared_columns_are_nullable():
    schema = declared_schema({"a": "int64", "b": "string"})
    assert all(f.nullable for f in schema)
    assert schema.names == ["a", "b"]


def test_column_declarations_are_equivalent():
    want = [Column("a", "int64"), Column("b", "string")]
    assert as_columns({"a": "int64", "b": "string"}) == want
    assert as_columns([("a", "int64"), ("b", "string")]) == want
    assert as_columns(T.StructType.fromDDL("a bigint, b string")) == want
    nested = T.StructType.fromDDL("a array<float>, m map<string,int>, d decimal(9,2)")
    assert declared_schema(as_columns(nested)) == nested
    with pytest.raises(UnsupportedTypeError):
        declared_name(T.DayTimeIntervalType())


def test_jdbc_types():
    assert jdbc_spark_type("FLOAT") == T.FloatType()
    assert jdbc_spark_type("decimal", 12, 2) == T.DecimalType(12, 2)
    assert jdbc_spark_type("TIMESTAMP") == T.TimestampNTZType()
    assert jdbc_spark_type("TIMESTAMP", calendar=True) == T.TimestampType()
    assert jdbc_spark_type("ARRAY", element=T.LongType()) == T.ArrayType(T.LongType())
    with pytest.raises(InvalidParameterError):
        jdbc_spark_type("ARRAY")
    with pytest.raises(UnsupportedTypeError):
        jdbc_spark_type("ROWID")


def test_mysql_types():
    assert mysql_type(T.DecimalType(12, 2)) == "DECIMAL(12,2)"
    assert mysql_type(T.TimestampNTZType()) == "TIMESTAMP DEFAULT '2000-01-01 00:00:00'"
    assert mysql_type(T.TimestampType(), timestamp_default=False) == "TIMESTAMP"
    assert mysql_type(T.FloatType()) == "REAL"
    assert mysql_type(T.MapType(T.StringType(), T.StringType())) == "TEXT"
    for bad in (T.NullType(), T.StructType(), T.DayTimeIntervalType()):
        with pytest.raises(UnsupportedTypeError):
            mysql_type(bad)


def test_warehouse_types():
    assert warehouse_type(T.DateType()) == T.DateType()
    with pytest.raises(UnsupportedTypeError):
        warehouse_type(T.ArrayType(T.LongType()))
