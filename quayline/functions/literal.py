"""SQL text: literals and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BARE = (T.NumericType, T.BooleanType)


def quote_ident(name: str) -> str:
    """A backtick-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def quote_text(text: str) -> str:
    """A single-quoted SQL string; quotes and backslashes are doubled, as Spark and MySQL want."""
    return "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"


def sql_literal(value: Column, data_type: T.DataType) -> Column:
    """A value as SQL literal text: numbers and booleans bare, the rest quoted, NULL as NULL."""
    if isinstance(data_type, _BARE):
        return value.cast("string")
    if isinstance(data_type, T.BinaryType):
        text = F.decode(value, "UTF-8")
    elif isinstance(data_type, (T.MapType, T.ArrayType, T.StructType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return F.concat(F.lit("'"), escaped, F.lit("'"))
