"""CSV reading and writing over the given tables."""

import re

from pyspark.sql import functions as F

from quayline.plans import read_dataset, write_dataset
from quayline.refs import CsvFormat, DatasetRef
from quayline.sinks.csv import csv_projection, render_csv, write_csv
from quayline.sources.csv import bad_values, infer_csv_schema, read_csv
from quayline.workloads.registry import query


@query("SELECT * FROM orders")
def csv_roundtrip_orders(t):
    ref = DatasetRef.of(t.source(), t.relative("orders"), t["orders"].schema)
    write_dataset(t["orders"], ref)
    return read_dataset(t.spark, ref)


@query("SELECT * FROM lineitem")
def csv_roundtrip_lineitem(t):
    path = t.path("lineitem")
    write_csv(t["lineitem"], path)
    return read_csv(t.spark, path, t["lineitem"].schema, encoding="UTF-8")


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
              CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part"""
)
def csv_infer_header_part(t):
    path = t.path("part")
    write_csv(t["part"], path)
    schema = infer_csv_schema(t.spark, path)
    return read_csv(t.spark, path).select(*schema.names)


@query("SELECT p_brand, p_partkey FROM part")
def csv_project_reorder_part(t):
    path = t.path("part")
    write_csv(t["part"], path)
    return read_csv(t.spark, path, {"p_brand": "string", "p_partkey": "int64"})


@query("SELECT s_suppkey AS supplier_id, s_acctbal AS balance, s_name FROM supplier")
def csv_field_map_supplier(t):
    path = t.path("supplier")
    write_csv(t["supplier"], path)
    fmt = CsvFormat(field_map={"s_suppkey": "supplier_id", "s_acctbal": "balance"})
    declared = {"supplier_id": "int64", "balance": "float64", "s_name": "string"}
    return read_csv(t.spark, path, declared, fmt=fmt)


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING'")
def csv_filter_customer(t):
    ref = DatasetRef.of(t.source(), t.relative("customer"), t["customer"].schema)
    write_dataset(t["customer"], ref)
    return read_dataset(
        t.spark, ref, ["c_custkey", "c_name"], where="c_acctbal > 0 AND c_mktsegment <> 'BUILDING'"
    )


def _one_line(df):
    return df.withColumn("text", F.translate("text", "\r\n", "  "))


def _marked(t):
    """Conversations with a column that no two charsets write alike."""
    return _one_line(t["conversations"]).withColumn("mark", F.concat(F.lit("汉字 € "), F.col("role")))


_MARKED_SQL = """SELECT conv_id, turn, role, translate(text, chr(13) || chr(10), '  ') AS text, '汉字 € ' || role AS mark
                 FROM conversations"""


@query(_MARKED_SQL)
def csv_gb18030_conversations(t):
    path, rows = t.path("gb18030"), _marked(t)
    write_csv(rows, path, encoding="GB18030")
    return read_csv(t.spark, path, rows.schema)


@query(_MARKED_SQL)
def csv_declared_charset_conversations(t):
    rows = _marked(t)
    ref = DatasetRef.of(t.source(), t.relative("declared"), rows.schema, csv=CsvFormat(encoding="GB18030"))
    write_dataset(rows, ref)
    return read_dataset(t.spark, ref)


@query(_MARKED_SQL)
def csv_mixed_charsets_conversations(t):
    path = t.path("mixed")
    rows = _marked(t)
    third = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    for i, encoding in enumerate(["UTF-8", "GB18030", "UTF-16"]):
        write_csv(rows.where(third == i), path, encoding=encoding, mode="append", max_records_per_file=20_000)
    return read_csv(t.spark, path, rows.schema)


# Charsets a byte order mark can announce.
_MARKED = ["UTF-8", "UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE"]


@query(
    "SELECT e.encoding, c.* FROM customer c CROSS JOIN (VALUES "
    + ", ".join(f"('{e}')" for e in _MARKED)
    + ") AS e(encoding)"
)
def csv_bom_variants_customer(t):
    customer = t["customer"]
    first = customer.columns[0]
    parts = []
    for encoding in _MARKED:
        path = t.path("bom")
        # The mark is the first character of the file, so it rides on the header.
        marked = customer.withColumnRenamed(first, "\ufeff" + first)
        # A two- or four-byte file is one task: bound the rows per file.
        write_csv(marked, path, encoding=encoding, max_records_per_file=100_000)
        parts.append(read_csv(t.spark, path, customer.schema).select(F.lit(encoding).alias("encoding"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("SELECT doc_id, md5(text) AS digest, lang, source, n_chars FROM documents")
def csv_multiline_documents(t):
    path = t.path("documents")
    # A file is one task when fields hold line breaks: bound the rows per file.
    write_csv(t["documents"], path, max_records_per_file=20_000)
    rows = read_csv(t.spark, path, t["documents"].schema, encoding="UTF-8", multiline=True)
    return rows.select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars")


#: Ranges of the queries below: small, so that the given tables are many of them.
RANGE_BYTES = 64 * 1024


@query(
    "SELECT doc_id, md5(text) AS digest, lang, source, n_chars, TRUE AS several_tasks FROM documents"
)
def csv_multiline_ranges_documents(t):
    path = t.path("documents")
    # One file whose fields hold line breaks, read by many tasks.
    write_csv(t["documents"], path, single_file=True)
    rows = read_csv(t.spark, path, t["documents"].schema, encoding="UTF-8", multiline=True, range_bytes=RANGE_BYTES)
    several = F.lit(rows.rdd.getNumPartitions() > 1)
    return rows.select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars", several.alias("several_tasks"))


@query(
    "SELECT e.encoding, c.conv_id, c.turn, c.role, md5(c.text) AS digest, TRUE AS several_tasks FROM conversations c CROSS JOIN (VALUES "
    + ", ".join(f"('{e}')" for e in [*_MARKED, "GB18030"])
    + ") AS e(encoding)"
)
def csv_charset_ranges_conversations(t):
    """One multi-line file in every charset, with its byte order mark where it has one, found and read in ranges."""
    talks, parts = t["conversations"], []
    for encoding in [*_MARKED, "GB18030"]:
        path = t.path("wide")
        mark = "\ufeff" if encoding in _MARKED else ""
        # The Chinese column makes sure that GB18030 is told from UTF-8.
        marked = talks.select(F.col("conv_id").alias(mark + "conv_id"), "turn", "role", "text", F.lit("汉字").alias("mark"))
        write_csv(marked.coalesce(1), path, encoding=encoding)
        rows = read_csv(t.spark, path, talks.schema, multiline=True, range_bytes=RANGE_BYTES // 16)
        several = F.lit(rows.rdd.getNumPartitions() > 1).alias("several_tasks")
        parts.append(rows.select(F.lit(encoding).alias("encoding"), "conv_id", "turn", "role", F.md5("text").alias("digest"), several))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    """SELECT item_id, md5(text) AS digest FROM benchmark
       UNION ALL SELECT doc_id, md5(text) FROM documents"""
)
def csv_quote_dialect_texts(t):
    path = t.path("dialect")
    texts = t["benchmark"].unionByName(t["documents"].select(F.col("doc_id").alias("item_id"), "text"))
    fmt = CsvFormat(separator=";", quote="'", escape="\\")
    write_csv(texts, path, fmt, max_records_per_file=20_000)
    rows = read_csv(t.spark, path, texts.schema, fmt=fmt, encoding="UTF-8", multiline=True)
    return rows.select("item_id", F.md5("text").alias("digest"))


@query("SELECT * FROM orders")
def csv_single_file_orders(t):
    path = t.path("orders")
    write_csv(t["orders"], path, single_file=True)
    return read_csv(t.spark, path + "/data.csv", t["orders"].schema)


@query("SELECT event_id, nullif(event_type, 'error') AS event_type FROM events")
def csv_empty_as_null_events(t):
    path = t.path("events")
    blanked = t["events"].select(
        "event_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type")
    )
    write_csv(blanked, path)
    return read_csv(t.spark, path, blanked.schema)


@query("SELECT nullif(event_type, 'error') AS event_type FROM events")
def csv_single_column_events(t):
    path = t.path("events")
    write_csv(t["events"].select(F.nullif("event_type", F.lit("error")).alias("event_type")), path)
    return read_csv(t.spark, path)


@query("SELECT doc_id, quality <> 0 AS quality, toxic <> 0 AS toxic FROM labels")
def csv_bool_labels(t):
    path = t.path("labels")
    # Digits for one column, words in mixed case for the other.
    words = F.when(F.col("toxic") != 0, F.when(F.col("doc_id") % 2 == 0, "TRUE").otherwise("true")).otherwise("False")
    write_csv(t["labels"].withColumn("toxic", words), path)
    return read_csv(t.spark, path, {"doc_id": "int64", "quality": "bool", "toxic": "bool"})


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def csv_epoch_day_orders(t):
    path = t.path("orders")
    days = t["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    write_csv(days, path)
    return read_csv(t.spark, path, {"o_orderkey": "int64", "o_orderdate": "date32"})


@query("SELECT event_id, ts, date_trunc('milliseconds', ts) AS ts_ms FROM events")
def csv_iso_timestamps_events(t):
    path = t.path("events")
    write_csv(t["events"].select("event_id", "ts", F.col("ts").alias("ts_ms")), path)
    return read_csv(t.spark, path, {"event_id": "int64", "ts": "timestamp", "ts_ms": "date64"})


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_partkey % 65536 AS INTEGER) AS part_low,
              CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_orderkey AS DECIMAL(20, 0)) AS order_wide FROM lineitem"""
)
def csv_unsigned_lineitem(t):
    path = t.path("lineitem")
    rows = t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") % 65536).alias("part_low"),
        "l_suppkey",
        F.col("l_orderkey").alias("order_wide"),
    )
    write_csv(rows, path)
    declared = {
        "l_orderkey": "int64",
        "l_linenumber": "uint8",
        "part_low": "uint16",
        "l_suppkey": "uint32",
        "order_wide": "uint64",
    }
    return read_csv(t.spark, path, declared)


@query("SELECT * FROM customer")
def csv_blank_lines_skipped_customer(t):
    path = t.path("customer")
    customer = t["customer"]
    # Every row, then an empty line. Text files cannot repeat a header, so columns go by position.
    render_csv(customer).select(F.explode(F.array("line", F.lit("")))).write.text(path)
    fmt = CsvFormat(header=False, field_map={f"_c{i}": name for i, name in enumerate(customer.columns)})
    return read_csv(t.spark, path, customer.schema, fmt=fmt)


@query(
    """SELECT p_partkey, p_brand, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_size END AS p_size FROM part"""
)
def csv_ragged_rows_padded_part(t):
    path = t.path("ragged")
    short = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_brand")
    full = F.concat_ws(",", short, F.col("p_size").cast("string"), F.lit("beyond"))
    lines = t["part"].select(F.when(F.col("p_size") % 2 == 0, short).otherwise(full).alias("p_partkey,p_brand,p_size"))
    lines.write.option("header", "true").option("quote", "").option("sep", "\u0001").csv(path)
    return read_csv(
        t.spark, path, {"p_partkey": "int64", "p_brand": "string", "p_size": "int32"}, ragged="trim"
    )


@query(
    """SELECT 'p_size' AS "column", 'size ' || p_size AS "value", 'int32' AS "type" FROM part WHERE p_size % 5 = 0
       UNION ALL SELECT 'p_brand', p_brand, 'bool' FROM part"""
)
def csv_bad_values_part(t):
    path = t.path("bad")
    size = F.col("p_size").cast("string")
    odd = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("size "), size)).otherwise(size)
    write_csv(t["part"].select("p_partkey", "p_brand", odd.alias("p_size")), path)
    text = read_csv(t.spark, path)
    return bad_values(text, {"p_partkey": "int64", "p_brand": "bool", "p_size": "int32"})


@query("SELECT concat_ws(',', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) AS line FROM part")
def csv_render_part(t):
    return render_csv(t["part"])


@query(
    """SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f'),
                        o_orderpriority) AS line FROM orders"""
)
def csv_content_orders(t):
    ref = DatasetRef.of(t.source(), t.relative("orders"), t["orders"].schema)
    write_dataset(t["orders"], ref)
    return read_dataset(t.spark, ref, content_type="csv")


@query("SELECT conv_id, turn, role FROM conversations")
def csv_unquoted_conversations(t):
    path, rows = t.path("unquoted"), t["conversations"].select("conv_id", "turn", "role")
    write_csv(rows, path, quoting="none")
    return read_csv(t.spark, path, rows.schema)


@query(
    """SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN p_name END AS p_name, CASE WHEN p_size % 3 = 2 THEN p_size END AS p_size
       FROM part"""
)
def csv_padded_part(t):
    # Rows of one, two and three fields below a header of three.
    path = t.path("ragged")
    fields = F.array(F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_size").cast("string"))
    lines = F.array_join(F.slice(fields, F.lit(1), F.col("p_size") % 3 + 1), ",")
    lines = t["part"].select(lines.alias("p_partkey,p_name,p_size"))
    lines.write.option("header", "true").option("quote", "").option("sep", "\u0001").csv(path)
    columns = {"p_partkey": "int64", "p_name": "string", "p_size": "int32"}
    return read_csv(t.spark, path, columns, ragged="pad")


@query(
    """SELECT p_partkey, 'p_size' AS "column", 'size ' || p_size AS "value", 'int64' AS "type" FROM part
       WHERE p_partkey = (SELECT min(p_partkey) FROM part)"""
)
def csv_padded_bad_value_part(t):
    # One bad value in a padded read stops it, and the message names column, value and type.
    path, first = t.path("bad"), t["part"].agg(F.min("p_partkey")).first()[0]
    size = F.col("p_size").cast("string")
    odd = F.when(F.col("p_partkey") == first, F.concat(F.lit("size "), size)).otherwise(size)
    write_csv(t["part"].select("p_partkey", odd.alias("p_size")), path)
    try:
        read_csv(t.spark, path, {"p_partkey": "int64", "p_size": "int64"}, ragged="pad").collect()
        found = None
    except Exception as e:
        found = re.search(r"column (\w+): value '([^']*)' is not (\w+)", str(e))
    named = [F.lit(found[i + 1] if found else None).alias(n) for i, n in enumerate(("column", "value", "type"))]
    return t["part"].where(F.col("p_partkey") == first).select("p_partkey", *named)


@query(
    """SELECT event_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day,
              strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, event_type AS event_bytes FROM events"""
)
def csv_value_text_events(t):
    e = t["events"]
    return csv_projection(
        e.select(
            "event_id",
            F.to_date("ts").alias("day"),
            "ts",
            F.encode("event_type", "UTF-8").alias("event_bytes"),
        )
    )
