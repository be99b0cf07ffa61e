"""Date, time-of-day and timestamp conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.functions.text import _checked, to_signed

# Ticks per second of each time unit.
UNITS = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}

ISO_LOCAL_DATE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _ticks(unit: str) -> int:
    if unit not in UNITS:
        raise InvalidParameterError(f"unknown time unit {unit!r}")
    return UNITS[unit]


def to_millis(ts: Column) -> Column:
    """Drop what lies below the millisecond (toward the earlier instant)."""
    return F.date_trunc("millisecond", ts)


def ntz_to_millis(ts: Column) -> Column:
    """``to_millis`` that keeps a timestamp without time zone as such."""
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def epoch_day_to_date(text: Column, column: str = "value", on_error: str = "fail") -> Column:
    """Epoch-day integer text to a date."""
    return F.date_from_unix_date(to_signed(text, "int32", column, on_error))


def date_to_epoch_day(day: Column) -> Column:
    return F.unix_date(day)


def _local(text: Column) -> Column:
    """Local date-time text as a timestamp; text with an offset or a zone is not local."""
    time_part = F.substring(text, 12, 64)
    zoned = time_part.contains("+") | time_part.contains("-") | ~F.right(text, F.lit(1)).between("0", "9")
    return F.when(~zoned, text.try_cast("timestamp_ntz"))


def iso_to_timestamp(text: Column, column: str = "value", on_error: str = "fail") -> Column:
    """ISO local date-time text to a timestamp without time zone, full precision."""
    return _checked(text, _local(text), "timestamp", column, on_error)


def iso_to_date64(text: Column, column: str = "value", on_error: str = "fail") -> Column:
    """ISO local date-time text to a date64 value (millisecond precision)."""
    return ntz_to_millis(_checked(text, _local(text), "date64", column, on_error))


def timestamp_to_iso(ts: Column) -> Column:
    """A timestamp as ISO local date-time text with microseconds."""
    return F.date_format(ts, ISO_LOCAL_DATE_TIME)


def rescale_time(ticks: Column, source: str, target: str) -> Column:
    """Time of day between s / ms / us / ns ticks; finer digits are dropped."""
    a, b = _ticks(source), _ticks(target)
    if b >= a:
        return ticks.cast("bigint") * F.lit(b // a)
    return F.floor(ticks.cast("decimal(20,0)") / F.lit(a // b)).cast("bigint")


def time_of_day_millis(ts: Column) -> Column:
    """Milliseconds since midnight of a timestamp."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    fraction = F.floor(F.date_format(ts, "SSSSSS").cast("bigint") / 1000)
    return (seconds.cast("bigint") * 1000 + fraction).cast("bigint")


def epoch_to_timestamp(ticks: Column, unit: str, time_zone: str | None = None) -> Column:
    """Epoch ticks to a timestamp; with a zone, to that zone's local date-time."""
    size = _ticks(unit)
    if size <= 1_000_000:
        micros = ticks.cast("bigint") * F.lit(1_000_000 // size)
    else:
        micros = F.floor(ticks.cast("decimal(20,0)") / F.lit(size // 1_000_000)).cast("bigint")
    ts = F.timestamp_micros(micros)
    return ts if time_zone is None else F.from_utc_timestamp(ts, time_zone)


def split_epoch(ticks: Column, unit: str) -> Column:
    """Epoch ticks as ``struct(seconds, nanos)`` with 0 <= nanos < 1e9."""
    size = _ticks(unit)
    nanos = F.pmod(ticks.cast("bigint"), F.lit(size).cast("bigint"))
    seconds = F.floor((ticks.cast("decimal(20,0)") - nanos) / F.lit(size)).cast("bigint")
    return F.struct(seconds.alias("seconds"), (nanos * F.lit(UNITS["ns"] // size)).cast("int").alias("nanos"))
