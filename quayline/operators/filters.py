"""Row filters: key ranges, partition specs and free text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.errors import InvalidPartitionSpecError
from quayline.operators.columns import column, equals_all

# Characters allowed in partition keys and values.
SAFE_NAME = re.compile(r"[·A-Za-z0-9一-龥\-_,.]*")


def range_filter(df: DataFrame, key: str, lower, upper) -> DataFrame:
    """Rows with ``lower <= key < upper``."""
    return df.where((column(key) >= F.lit(lower)) & (column(key) < F.lit(upper)))


def text_filter(df: DataFrame, condition: str | None) -> DataFrame:
    """Rows satisfying a SQL condition; no condition keeps all rows."""
    return df.where(F.expr(condition)) if condition else df


def check_name(text: str, what: str) -> str:
    """Refuse names and values outside the allowed characters."""
    if not text or not SAFE_NAME.fullmatch(text):
        raise InvalidPartitionSpecError(f"invalid {what}: {text!r}")
    return text


def parse_partition_spec(spec: str | None) -> dict[str, str]:
    """``k=v[,k2=v2]``, also separated by ``/``, as an ordered dict of text values."""
    pairs: dict[str, str] = {}
    for part in re.split("[,/]", spec or ""):
        if not part.strip():
            continue
        key, sign, value = part.partition("=")
        key, value = key.strip(), value.strip()
        if value[:1] in "'\"" and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        if not sign:
            raise InvalidPartitionSpecError(f"partition spec part {part!r} has no '='")
        check_name(key, "partition key")
        check_name(value, "partition value")
        if key in pairs:
            raise InvalidPartitionSpecError(f"partition key {key!r} is given twice")
        pairs[key] = value
    if spec and not pairs:
        raise InvalidPartitionSpecError(f"invalid partition spec: {spec!r}")
    return pairs


def partition_filter(df: DataFrame, spec: str | None, partition_columns) -> DataFrame:
    """Rows of the partitions a spec names; unpartitioned tables ignore the spec."""
    pairs = parse_partition_spec(spec)
    if not pairs or not partition_columns:
        return df
    known = {c.lower(): c for c in partition_columns}
    unknown = [k for k in pairs if k.lower() not in known]
    if unknown:
        raise InvalidPartitionSpecError(f"not a partition column: {', '.join(unknown)}")
    return df.where(equals_all({known[k.lower()]: v for k, v in pairs.items()}))
