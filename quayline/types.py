"""Column type vocabularies and their Spark counterparts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, UnsupportedTypeError

# Declared column type names and the Spark type that holds them.
# Unsigned integers widen to the next signed type, with a range check on read.
DECLARED_TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "int": T.LongType(),
    "uint8": T.ShortType(),
    "unit8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float16": T.FloatType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "float": T.DoubleType(),
    "date32": T.DateType(),
    "date64": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "str": T.StringType(),
    "binary": T.BinaryType(),
}

UNSIGNED_BITS = {"uint8": 8, "unit8": 8, "uint16": 16, "uint32": 32, "uint64": 64}
SIGNED_BITS = {"int8": 8, "int16": 16, "int32": 32, "int64": 64, "int": 64}

# The type name used when a Spark schema is declared as columns.
_NAME_OF_TYPE = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "date": "date32",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
    "boolean": "bool",
    "string": "string",
    "binary": "binary",
}

# MySQL column types.
_MYSQL_TYPES = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INT",
    "bigint": "BIGINT",
    "float": "REAL",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "string": "TEXT",
    "binary": "BLOB",
}
MYSQL_TIMESTAMP_DEFAULT = "2000-01-01 00:00:00"

# JDBC type names and the Spark type a scan gives for them.
_JDBC_TYPES: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "BIT": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "REAL": T.FloatType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "CHAR": T.StringType(),
    "NCHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "NVARCHAR": T.StringType(),
    "LONGVARCHAR": T.StringType(),
    "LONGNVARCHAR": T.StringType(),
    "CLOB": T.StringType(),
    "DATE": T.DateType(),
    "TIME": T.LongType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "BINARY": T.BinaryType(),
    "VARBINARY": T.BinaryType(),
    "LONGVARBINARY": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "NULL": T.NullType(),
}


@dataclass(frozen=True)
class Column:
    """One declared column: its name and its declared type name."""

    name: str
    type: str

    @property
    def spark(self) -> T.DataType:
        return spark_type(self.type)


# Type names beyond the fixed ones are Spark's own, for types a name alone cannot tell.
_PARAMETRIC = ("decimal(", "array<", "map<", "struct<")
NESTED = ("array<", "map<", "struct<")


def spark_type(name: str) -> T.DataType:
    """The Spark type of a declared type name."""
    if name in DECLARED_TYPES:
        return DECLARED_TYPES[name]
    if name.startswith(_PARAMETRIC):
        try:
            return T.DataType.fromDDL(name)
        except Exception as cause:
            raise InvalidParameterError(f"unsupported column type {name!r}") from cause
    raise InvalidParameterError(f"unsupported column type {name!r}")


def as_columns(declared) -> list[Column]:
    """Accept ``{name: type}``, ``[(name, type)]``, ``[Column]`` or a StructType."""
    if declared is None:
        return []
    if isinstance(declared, T.StructType):
        return [Column(f.name, declared_name(f.dataType)) for f in declared]
    pairs = declared.items() if isinstance(declared, dict) else declared
    columns = [c if isinstance(c, Column) else Column(*c) for c in pairs]
    for column in columns:
        spark_type(column.type)
    return columns


def declared_name(data_type: T.DataType) -> str:
    """The declared type name that a Spark type is announced under."""
    if isinstance(data_type, (T.DecimalType, T.ArrayType, T.MapType, T.StructType)):
        return data_type.simpleString()
    name = _NAME_OF_TYPE.get(data_type.simpleString())
    if name is None:
        raise UnsupportedTypeError(f"no declared type name for {data_type.simpleString()}")
    return name


def declared_schema(declared) -> T.StructType:
    """Declared columns as a schema; every declared column is nullable."""
    return T.StructType([T.StructField(c.name, c.spark, True) for c in as_columns(declared)])


def jdbc_spark_type(
    jdbc_type: str,
    precision: int | None = None,
    scale: int | None = None,
    calendar: bool = False,
    element: T.DataType | None = None,
) -> T.DataType:
    """The Spark type for a JDBC column type; unknown types raise instead of vanishing."""
    name = jdbc_type.upper()
    if name in ("DECIMAL", "NUMERIC"):
        return T.DecimalType(38 if precision is None else precision, 0 if scale is None else scale)
    if name == "TIMESTAMP" and calendar:
        return T.TimestampType()
    if name == "ARRAY":
        if element is None:
            raise InvalidParameterError("an ARRAY column needs its element type")
        return T.ArrayType(element)
    if name not in _JDBC_TYPES:
        raise UnsupportedTypeError(f"unsupported JDBC type {jdbc_type}")
    return _JDBC_TYPES[name]


def mysql_type(data_type: T.DataType, timestamp_default: bool = True) -> str:
    """The MySQL column type text for a Spark type."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return f"TIMESTAMP DEFAULT '{MYSQL_TIMESTAMP_DEFAULT}'" if timestamp_default else "TIMESTAMP"
    if isinstance(data_type, (T.MapType, T.ArrayType)):
        return "TEXT"
    name = data_type.simpleString()
    if name.startswith("time("):
        return "TIME" + name[len("time"):]
    if name not in _MYSQL_TYPES:
        raise UnsupportedTypeError(f"no MySQL column type for {name}")
    return _MYSQL_TYPES[name]


def warehouse_type(data_type: T.DataType) -> T.DataType:
    """The type a warehouse table column gets; nested and null types are rejected."""
    if isinstance(data_type, T.AtomicType):
        return data_type
    raise UnsupportedTypeError(f"no warehouse column type for {data_type.simpleString()}")
