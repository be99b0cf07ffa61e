"""CSV scans: charset, header, declared types, projection and renaming."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import HeaderMissingError, InvalidParameterError, MissingFieldError
from quayline.functions import (
    as_unsigned,
    epoch_day_to_date,
    iso_to_date64,
    iso_to_timestamp,
    to_boolean,
    to_decimal,
    to_floating,
    to_signed,
    to_unsigned,
    utf8_bytes,
)
from quayline.operators.columns import column, validate_field_map
from quayline.refs import CsvFormat
from quayline.session import configure
from quayline.sources import framing
from quayline.sources.binary import arrow_options
from quayline.sources.charset import WIDE, paths_by_charset
from quayline.types import NESTED, SIGNED_BITS, UNSIGNED_BITS, Column, as_columns, spark_type

# Fixed value: fields per row Spark's CSV parser makes room for by default.
DEFAULT_MAX_COLUMNS = 20_480

# Column of the scan that holds a record as text where it does not fit the schema.
_RECORD = "__record"

# Declared types Spark's CSV parser reads strictly by itself, and the type it is
# asked for; the rest are scanned as text and converted by an expression.
_NATIVE = {
    **{n: spark_type(n) for n in ("int8", "int16", "int32", "int64", "int", "float16", "float32", "float64", "float")},
    **{n: T.LongType() for n in ("uint8", "unit8", "uint16", "uint32")},
    "date32": T.IntegerType(),
}


def scan_options(fmt: CsvFormat, encoding: str, multiline: bool, ragged: str) -> dict[str, str]:
    """Options of ``spark.read.csv`` for one charset."""
    if ragged not in ("fail", "pad", "trim"):
        raise InvalidParameterError(f"ragged must be 'fail', 'pad' or 'trim', not {ragged!r}")
    wide = encoding.upper().startswith(WIDE)
    options = {
        **fmt.dialect(),
        "header": str(fmt.header).lower(),
        "encoding": encoding,
        # Malformed records are kept aside as text, so that the error can name column, value and type.
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _RECORD,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        # Line splitting works on bytes, so it is unsafe for two- and four-byte charsets.
        "multiLine": str(multiline or wide).lower(),
        # With a given schema, check every file's own header against it.
        "enforceSchema": "false",
        # Pruned parsing looks only at the wanted fields and misses a short or long row.
        "columnPruning": "false",
    }
    return options


def header_names(spark: SparkSession, paths, options: dict[str, str]) -> list[str]:
    """Column names from the header line, or positions where there is none."""
    names = spark.read.options(**{**options, "maxColumns": "1000000"}).csv(paths).columns
    if not names:
        raise HeaderMissingError(f"no CSV header line in {paths}")
    return names


def convert(text: SparkColumn, declared: Column, on_error: str = "fail") -> SparkColumn:
    """One CSV text column to its declared type."""
    kind, name = declared.type, declared.name
    if kind in ("string", "str"):
        return text
    if kind in SIGNED_BITS:
        return to_signed(text, kind, name, on_error)
    if kind in UNSIGNED_BITS:
        return to_unsigned(text, kind, name, on_error)
    if kind in ("float16", "float32", "float64", "float"):
        return to_floating(text, kind, name, on_error)
    if kind == "bool":
        return to_boolean(text, name, on_error)
    if kind == "date32":
        return epoch_day_to_date(text, name, on_error)
    if kind == "date64":
        return iso_to_date64(text, name, on_error)
    if kind == "timestamp":
        return iso_to_timestamp(text, name, on_error)
    if kind.startswith("decimal("):
        return to_decimal(text, declared.spark.precision, declared.spark.scale, name, on_error)
    if kind.startswith(NESTED):
        return F.from_json(text, declared.spark, {"mode": "FAILFAST" if on_error == "fail" else "PERMISSIVE"})
    return utf8_bytes(text)


def read_csv(
    spark: SparkSession,
    paths,
    columns=None,
    select=None,
    fmt: CsvFormat | None = None,
    encoding: str | None = None,
    multiline: bool = False,
    ragged: str = "fail",
    range_bytes: int = framing.RANGE_BYTES,
) -> DataFrame:
    """Scan a CSV dataset.

    ``columns`` declares view names and types and also selects: only declared
    columns are returned. Without it every header column is nullable text.
    ``select`` narrows and orders the result. Without ``encoding``, here or
    in the format, the bytes are looked at in a pass of their own. ``ragged`` says
    what becomes of rows that do not have as many fields as the header: ``fail``
    stops, ``pad`` fills short ones with NULL and stops at long ones, ``trim``
    also leaves out what a row has beyond the header. ``multiline`` lets a quoted field hold line breaks. Such files,
    and those of two- or four-byte charsets, are read whole by a task up to ``range_bytes``; longer ones are read
    in ranges of that size by separate tasks, in two passes over the bytes.
    """
    configure(spark)
    fmt = fmt or CsvFormat()
    roots = [paths] if isinstance(paths, str) else list(paths)
    encoding = encoding or fmt.encoding
    groups = {encoding: roots} if encoding else paths_by_charset(spark, roots)

    scans = []
    for charset, files in groups.items():
        options = scan_options(fmt, charset, multiline, ragged)
        header = header_names(spark, files, options)
        if options["multiLine"] == "true" and (found := _ranges(spark, files, charset, fmt, range_bytes)) is not None:
            scans.append(_scan_ranges(found, options, header, as_columns(columns), select, fmt, ragged, charset))
        else:
            scans.append(_scan(spark.read, files, options, header, as_columns(columns), select, fmt, ragged))
    return reduce(lambda a, b: a.unionByName(b), scans)


def csv_dialect(fmt: CsvFormat, quoted: bool) -> framing.Dialect:
    marks = fmt.dialect()
    return framing.Dialect(marks["sep"], marks["quote"], marks["escape"], quoted)


def _ranges(spark: SparkSession, files, charset: str, fmt: CsvFormat, range_bytes: int) -> DataFrame | None:
    """The ranges of files that are too long for one task; None where they are not, or cannot be read in ranges."""
    dialect, paths = csv_dialect(fmt, True), [files] if isinstance(files, str) else list(files)
    if not dialect.fits(charset) or arrow_options(spark, paths[0]) is None:
        return None
    listed = framing.listed(spark, paths)
    if not framing.rangeable(listed, range_bytes):
        return None
    return framing.cut_ranges(listed, range_bytes)


def scan_ranges(spark: SparkSession, paths, ranges, charset: str, columns, select, fmt: CsvFormat, ragged: str, multiline: bool, partitions) -> DataFrame:
    """The typed rows of ranges of CSV files, dealt to tasks by ``partitions``."""
    options = scan_options(fmt, charset, multiline, ragged)
    quoted = options["multiLine"] == "true"
    if not csv_dialect(fmt, quoted).fits(charset):
        raise InvalidParameterError(f"CSV in {charset} with these marks cannot be read in ranges")
    header = header_names(spark, paths, options)
    return _scan_ranges(ranges, options, header, as_columns(columns), select, fmt, ragged, charset, quoted, partitions)


def _scan_ranges(ranges, options, header, declared, select, fmt, ragged, charset, quoted: bool = True, partitions=None) -> DataFrame:
    """The typed rows of ranges ``(path, split, start, stop)``; ``partitions`` deals the framed ranges to tasks."""
    spark = ranges.sparkSession
    dialect = csv_dialect(fmt, quoted)
    some = ranges.select("path").first()
    stores = arrow_options(spark, some["path"]) if some else {}
    framed = framing.frame(ranges, charset, dialect, stores)
    records = framing.read_records((partitions or framing.spread)(framed), charset, dialect, stores)
    parse = {k: v for k, v in options.items() if k not in ("header", "encoding", "enforceSchema", "columnPruning")}
    # What a record holds is data: its own line breaks are kept, none is looked for.
    parse.update({"multiLine": "true", "lineSep": "\n"})

    def load(schema: T.StructType, wide: dict) -> DataFrame:
        rows = records
        if fmt.header:
            texts = ", ".join(f"c{i} string" for i in range(len(header)))
            own = F.from_csv("record", texts, {**parse, **wide, "mode": "PERMISSIVE"})
            same = F.array(*[own[f"c{i}"] for i in range(len(header))]).eqNullSafe(F.array(*[F.lit(h) for h in header]))
            message = F.concat(F.lit(f"a file's header is not {', '.join(header)}: "), F.col("record"))
            rows = rows.where(~F.col("head") | F.when(same, F.lit(False)).otherwise(F.raise_error(message).cast("boolean")))
        names = [f"c{i}" for i in range(len(header))] + [_RECORD]
        ddl = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema.fields))
        row = rows.select(F.from_csv("record", ddl, {**parse, **wide}).alias("row"))
        return row.select(*[F.col("row")[n].alias(f.name) for n, f in zip(names, schema.fields)])

    return _rows(load, header, declared, select, fmt, ragged)


def stream_csv(
    spark: SparkSession,
    path: str,
    columns,
    header=None,
    fmt: CsvFormat | None = None,
    encoding: str = "UTF-8",
    ragged: str = "fail",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Follow a folder of CSV files, with the types and checks of ``read_csv``.

    ``header`` names the raw columns in file order; by default they are the
    declared ones. Every file's own header line is checked against it.
    """
    configure(spark)
    fmt, declared = fmt or CsvFormat(), as_columns(columns)
    raw_of = {view: raw for raw, view in fmt.field_map.items()}
    header = list(header or [raw_of.get(c.name, c.name) for c in declared])
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _scan(reader, path, scan_options(fmt, encoding, False, ragged), header, declared, None, fmt, ragged)


def _scan(reader, files, options, header, declared, select, fmt, ragged) -> DataFrame:
    def load(schema: T.StructType, wide: dict) -> DataFrame:
        return reader.options(**options, **wide).schema(schema).csv(files)

    return _rows(load, header, declared, select, fmt, ragged)


def _rows(load, header, declared, select, fmt, ragged) -> DataFrame:
    """The declared columns of what ``load(schema, options)`` parses, checked and converted."""
    views = validate_field_map(header, fmt.field_map)
    raw_of = {view: raw for raw, view in views.items()}
    missing = [c.name for c in declared if c.name not in raw_of]
    if missing:
        raise MissingFieldError(f"not in the CSV header: {', '.join(missing)}")
    wanted = declared or [Column(view, "string") for view in views.values()]
    if select:
        by_name = {c.name: c for c in wanted}
        unknown = [s for s in select if s not in by_name]
        if unknown:
            raise MissingFieldError(f"no such column: {', '.join(unknown)}")
        wanted = [by_name[s] for s in select]

    # Padded rows are malformed records to the parser, which then gives no numbers: all are converted here.
    native = {raw_of[c.name]: _NATIVE[c.type] for c in wanted if c.type in _NATIVE and ragged == "fail"}
    schema = T.StructType([T.StructField(h, native.get(h, T.StringType()), True) for h in [*header, _RECORD]])
    # One more than the header, so that a row that is too long is seen as such.
    wide = {"maxColumns": str(len(header) + 1)} if len(header) >= DEFAULT_MAX_COLUMNS else {}
    df = load(schema, wide)
    record, first = column(_RECORD), column(raw_of[wanted[0].name]).cast("string")
    if ragged == "fail":
        fields = ", ".join(f"c{i} string" for i in range(len(header)))

        def complaint(r):
            text = F.from_csv(r, fields, fmt.dialect())
            checks = [_complaint(text[f"c{header.index(raw_of[c.name])}"], c) for c in wanted if c.type in _NATIVE]
            return F.coalesce(*checks, F.concat(F.lit(f"row does not have {len(header)} fields: "), r))

        # Inside a lambda the many checks stay out of the generated code of the rows that are fine.
        message = F.get(F.transform(F.array(record), complaint), F.lit(0))
        malformed = record.isNotNull()
    else:
        message = F.concat(F.lit(f"row has more than {len(header)} fields: "), record)
        malformed = _separators(record, fmt) >= len(header)
    # A column of the file has to be part of the condition: Spark refuses to look at the record alone.
    message = F.concat(message, F.lit(f" ({wanted[0].name} "), F.coalesce(first, F.lit("NULL")), F.lit(")"))
    if ragged != "trim":
        df = df.where(~F.coalesce(malformed, F.lit(False)) | F.raise_error(message).cast("boolean"))
    pick = _finish if ragged == "fail" else convert
    return df.select(*[pick(column(raw_of[c.name]), c).alias(c.name) for c in wanted])


def _complaint(text: SparkColumn, declared: Column) -> SparkColumn:
    """What is wrong with a field, NULL if nothing is."""
    failed = (text != "") & convert(text, declared, "null").isNull()
    named = F.concat(F.lit(f"column {declared.name}: value '"), text, F.lit(f"' is not {declared.type}"))
    return F.when(failed, named)


def _separators(record: SparkColumn, fmt: CsvFormat) -> SparkColumn:
    """Separators of a record outside of quotes."""
    marks = fmt.dialect()
    quote, escape, sep = (re.escape(marks[k]) for k in ("quote", "escape", "sep"))
    bare = F.regexp_replace(record, rf"(?s){quote}(?:{escape}.|{quote}{quote}|[^{quote}{escape}])*{quote}", "")
    return F.length(bare) - F.length(F.regexp_replace(bare, sep, ""))


def _finish(scanned: SparkColumn, declared: Column) -> SparkColumn:
    """A scanned column as its declared type."""
    if declared.type not in _NATIVE:
        return convert(scanned, declared)
    if declared.type in UNSIGNED_BITS:
        return as_unsigned(scanned, declared.type, declared.name)
    if declared.type == "date32":
        return F.date_from_unix_date(scanned)
    return scanned


def bad_values(df: DataFrame, columns) -> DataFrame:
    """``(column, value, type)`` of every text that does not parse as declared."""
    checks = []
    for c in as_columns(columns):
        text = column(c.name)
        failed = text.isNotNull() & (text != "") & convert(text, c, "null").isNull()
        checks.append(
            F.when(
                failed,
                F.struct(F.lit(c.name).alias("column"), text.alias("value"), F.lit(c.type).alias("type")),
            )
        )
    return df.select(F.explode(F.array_compact(F.array(*checks))).alias("bad")).select("bad.*")


def infer_csv_schema(
    spark: SparkSession, paths, fmt: CsvFormat | None = None, encoding: str | None = None
) -> T.StructType:
    """Header names as nullable text columns, renamed by the field map."""
    configure(spark)
    fmt = fmt or CsvFormat()
    encoding = encoding or fmt.encoding
    groups = {encoding: paths} if encoding else paths_by_charset(spark, paths)
    found = [header_names(spark, files, scan_options(fmt, e, False, "pad")) for e, files in groups.items()]
    names = found[0]
    if any(sorted(other) != sorted(names) for other in found):
        raise MissingFieldError(f"files of different charsets have different headers: {found}")
    return T.StructType(
        [T.StructField(v, T.StringType(), True) for v in validate_field_map(names, fmt.field_map).values()]
    )
