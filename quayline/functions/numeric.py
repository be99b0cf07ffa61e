"""Decimal conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayline.functions.text import _checked


def rescale_decimal(value: Column, precision: int, scale: int) -> Column:
    """Change a decimal's scale, rounding toward positive infinity."""
    return F.ceil(value, F.lit(scale)).cast(f"decimal({precision},{scale})")


def to_decimal(text: Column, precision: int, scale: int, column: str = "value", on_error: str = "fail") -> Column:
    """Text to a decimal; digits beyond the scale round toward positive infinity."""
    type_name = f"decimal({precision},{scale})"
    # All digits left of the point fit, and the rest of the 38 is kept for rounding.
    wide = text.try_cast(f"decimal(38,{38 - (precision - scale)})")
    value = F.when(~text.contains(" "), F.ceil(wide, F.lit(scale))).try_cast(type_name)
    return _checked(text, value, type_name, column, on_error)
