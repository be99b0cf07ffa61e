"""Scalar conversions as Column expressions; none of them needs a UDF."""

from quayline.functions.literal import quote_ident, quote_text, sql_literal
from quayline.functions.nested import (
    array_to_json,
    json_to_array,
    json_to_map,
    map_to_json,
    map_to_text_map,
    to_text_array,
)
from quayline.functions.numeric import rescale_decimal, to_decimal
from quayline.functions.temporal import (
    date_to_epoch_day,
    epoch_day_to_date,
    epoch_to_timestamp,
    iso_to_date64,
    iso_to_timestamp,
    ntz_to_millis,
    rescale_time,
    split_epoch,
    time_of_day_millis,
    timestamp_to_iso,
    to_millis,
)
from quayline.functions.text import (
    as_unsigned,
    empty_to_null,
    recast,
    to_boolean,
    to_floating,
    to_signed,
    to_unsigned,
    utf8_bytes,
    utf8_text,
)

__all__ = [
    "array_to_json",
    "as_unsigned",
    "date_to_epoch_day",
    "empty_to_null",
    "epoch_day_to_date",
    "epoch_to_timestamp",
    "iso_to_date64",
    "iso_to_timestamp",
    "json_to_array",
    "json_to_map",
    "map_to_json",
    "map_to_text_map",
    "ntz_to_millis",
    "quote_ident",
    "quote_text",
    "recast",
    "rescale_decimal",
    "rescale_time",
    "split_epoch",
    "sql_literal",
    "time_of_day_millis",
    "timestamp_to_iso",
    "to_boolean",
    "to_decimal",
    "to_floating",
    "to_millis",
    "to_signed",
    "to_text_array",
    "to_unsigned",
    "utf8_bytes",
    "utf8_text",
]
