"""Text to typed value conversions, as Column expressions.

Strict variants stop the job and name the column, the value and the type;
``on_error='null'`` turns a bad value into NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.types import SIGNED_BITS, UNSIGNED_BITS, spark_type


def _bare(text: Column) -> Column:
    """Starts like a number and ends in a digit, so a cast finds no blanks to strip.

    Plain text comparison; a pattern match would cost several times the cast.
    """
    return (text >= "+") & (text < ":") & F.right(text, F.lit(1)).between("0", "9")


def empty_to_null(text: Column) -> Column:
    """Empty text means NULL, whatever the target type."""
    return F.nullif(text, F.lit(""))


def _checked(text: Column, value: Column, type_name: str, column: str, on_error: str) -> Column:
    """``value`` where it exists; otherwise NULL for empty or absent text, else the error."""
    if on_error == "null":
        return value
    if on_error != "fail":
        raise InvalidParameterError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    message = F.concat(F.lit(f"column {column}: value '"), text, F.lit(f"' is not {type_name}"))
    # coalesce keeps the conversion itself evaluated once per value.
    return F.coalesce(value, F.when(text != "", F.raise_error(message).cast(spark_type(type_name))))


def to_signed(text: Column, type_name: str, column: str = "value", on_error: str = "fail") -> Column:
    """Text to int8 / int16 / int32 / int64, no blanks, no fraction, no overflow."""
    if type_name not in SIGNED_BITS:
        raise InvalidParameterError(f"{type_name} is not a signed integer type")
    value = F.when(_bare(text), text.try_cast(spark_type(type_name)))
    return _checked(text, value, type_name, column, on_error)


def to_unsigned(text: Column, type_name: str, column: str = "value", on_error: str = "fail") -> Column:
    """Text to an unsigned integer held in the next wider signed type."""
    if type_name not in UNSIGNED_BITS:
        raise InvalidParameterError(f"{type_name} is not an unsigned integer type")
    if type_name == "uint64":
        wide = F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("decimal(38,0)"))
    else:
        wide = F.when(_bare(text), text.try_cast("bigint"))
    value = F.when(_in_range(wide, type_name), wide).cast(spark_type(type_name))
    return _checked(text, value, type_name, column, on_error)


def _in_range(value: Column, type_name: str) -> Column:
    limit = 2 ** UNSIGNED_BITS[type_name] - 1
    top = F.lit(str(limit)).cast("decimal(38,0)") if type_name == "uint64" else F.lit(limit)
    return (value >= 0) & (value <= top)


def as_unsigned(value: Column, type_name: str, column: str = "value") -> Column:
    """A whole number checked against an unsigned type's range and held in its type."""
    text = value.cast("string")
    message = F.concat(F.lit(f"column {column}: value '"), text, F.lit(f"' is not {type_name}"))
    checked = F.when(value.isNull() | _in_range(value, type_name), value)
    return checked.otherwise(F.raise_error(message).cast("bigint")).cast(spark_type(type_name))


def to_floating(text: Column, type_name: str, column: str = "value", on_error: str = "fail") -> Column:
    """Text to float32 or float64."""
    return _checked(text, text.try_cast(spark_type(type_name)), type_name, column, on_error)


def to_boolean(text: Column, column: str = "value", on_error: str = "fail") -> Column:
    """true / false in any case, otherwise an integer where 0 is false."""
    lowered = F.lower(text)
    number = F.when(_bare(text), text.try_cast("int"))
    value = F.when(lowered == "true", True).when(lowered == "false", False).otherwise(number != 0)
    return _checked(text, value, "bool", column, on_error)


def utf8_bytes(text: Column) -> Column:
    """Text to its UTF-8 bytes."""
    return F.encode(text, "UTF-8")


def utf8_text(data: Column) -> Column:
    """UTF-8 bytes to text."""
    return F.decode(data, "UTF-8")


def recast(value: Column, data_type) -> Column:
    """Any value to another column type by way of its text; bad text is an error."""
    return value.cast("string").cast(data_type)
