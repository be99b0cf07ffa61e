"""Projection, renaming and schema checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, InvalidPartitionSpecError, MissingFieldError
from quayline.functions.literal import quote_ident
from quayline.functions.text import recast


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(quote_ident(name))


def project(df: DataFrame, columns=None) -> DataFrame:
    """Keep ``columns`` in the given order; no list keeps everything."""
    if not columns:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingFieldError(f"no such column: {', '.join(missing)}")
    return df.select(*[column(c) for c in columns])


def validate_field_map(names, field_map: dict[str, str] | None) -> dict[str, str]:
    """Complete a raw-to-view name map, refusing unknown and colliding names."""
    field_map = field_map or {}
    unknown = [raw for raw in field_map if raw not in names]
    if unknown:
        raise MissingFieldError(f"mapped column does not exist: {', '.join(unknown)}")
    full = {name: field_map.get(name, name) for name in names}
    seen: set[str] = set()
    for view in full.values():
        if view in seen:
            raise InvalidParameterError(f"duplicate column name {view!r} after mapping")
        seen.add(view)
    return full


def rename(df: DataFrame, field_map: dict[str, str] | None) -> DataFrame:
    """Apply a raw-to-view name map."""
    full = validate_field_map(df.columns, field_map)
    return df.select(*[column(raw).alias(view) for raw, view in full.items()])


# Type families that a page key may have.
_PAGE_KEY_TYPES = (T.IntegralType, T.DecimalType, T.FractionalType, T.DateType)


def choose_page_key(
    schema: T.StructType, declared: str | None = None, primary_key: str | None = None
) -> str | None:
    """The column to page on: the declared one if usable, else a usable primary key."""
    types = {f.name: f.dataType for f in schema}
    if declared:
        if declared not in types:
            raise InvalidParameterError(f"page key {declared!r} does not exist")
        if not isinstance(types[declared], _PAGE_KEY_TYPES):
            raise InvalidParameterError(f"page key {declared!r} is not numeric")
        return declared
    if primary_key and primary_key not in types:
        raise InvalidParameterError(f"primary key {primary_key!r} does not exist")
    if primary_key and isinstance(types.get(primary_key), _PAGE_KEY_TYPES):
        return primary_key
    return None


def resolve_case_insensitive(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Read a table under a declared schema: names match in any case, absent columns are NULL."""
    have: dict[str, T.StructField] = {}
    for f in df.schema:
        if f.name.lower() in have:
            raise InvalidParameterError(f"columns differ only in case: {f.name}")
        have[f.name.lower()] = f
    out = []
    for f in schema:
        found = have.get(f.name.lower())
        if found is None:
            value = F.lit(None).cast(f.dataType)
        elif found.dataType == f.dataType:
            value = column(found.name)
        else:
            value = _coerce(column(found.name), found.dataType, f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


def align_to_table(df: DataFrame, target: T.StructType) -> DataFrame:
    """Fit a frame to a table before a write: extra columns go, absent ones are NULL."""
    return resolve_case_insensitive(df, target)


def _coerce(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Convert between column types by way of the value's text."""
    if isinstance(target, T.BooleanType):
        if not isinstance(source, (T.BooleanType, T.StringType)):
            raise InvalidParameterError(f"cannot write {source.simpleString()} to a boolean column")
        return value.cast("boolean")
    if isinstance(source, (T.MapType, T.ArrayType, T.StructType)) or isinstance(
        target, (T.MapType, T.ArrayType, T.StructType)
    ):
        if isinstance(target, T.StringType):
            return F.to_json(value)
        return value.cast(target)
    if isinstance(source, T.BinaryType) and isinstance(target, T.StringType):
        return F.decode(value, "UTF-8")
    if isinstance(source, T.StringType) and isinstance(target, T.BinaryType):
        return F.encode(value, "UTF-8")
    return recast(value, target)


def dropped_columns(df: DataFrame, target: T.StructType) -> list[str]:
    """The columns ``align_to_table`` leaves out, for a warning."""
    known = {f.name.lower() for f in target}
    return [c for c in df.columns if c.lower() not in known]


def equals_all(pairs: dict[str, str]) -> Column:
    """AND of ``column = value``; values compare as text."""
    if not pairs:
        raise InvalidPartitionSpecError("the partition spec is empty")
    return reduce(lambda a, b: a & b, [column(k).cast("string") == F.lit(v) for k, v in pairs.items()])
