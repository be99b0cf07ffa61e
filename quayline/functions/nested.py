"""Map, array and JSON conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def json_to_map(text: Column) -> Column:
    """JSON object text to ``map<string,string>``; null members stay, null input is null."""
    return F.from_json(text, _TEXT_MAP, {"mode": "FAILFAST"})


def map_to_text_map(value: Column) -> Column:
    """Any map to ``map<string,string>``."""
    return value.cast(_TEXT_MAP)


def map_to_json(value: Column) -> Column:
    """A map as JSON object text; null members are kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def array_to_json(value: Column) -> Column:
    """An array as JSON text; null elements are kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_to_array(text: Column, element: T.DataType) -> Column:
    """JSON array text to an array of ``element``."""
    return F.from_json(text, T.ArrayType(element), {"mode": "FAILFAST"})


def to_text_array(value: Column) -> Column:
    """An array with every element as text; null elements stay null."""
    return value.cast(T.ArrayType(T.StringType()))
