"""Scalar conversions over the given tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline import functions as C
from quayline.sinks.csv import write_csv
from quayline.sources.csv import read_csv
from quayline.workloads.registry import ELEMENTS_SQL, elements, query


@query(
    """SELECT l_orderkey, l_linenumber,
              CAST(ceil(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) * 100) / 100 AS DECIMAL(18, 2))
                  AS price_up,
              CAST(ceil(CAST(-l_extendedprice * l_tax AS DECIMAL(18, 4)) * 10) / 10 AS DECIMAL(18, 1)) AS tax_up
       FROM lineitem"""
)
def decimal_ceiling_lineitem(t):
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    tax = (-F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,4)")
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        C.rescale_decimal(net, 18, 2).alias("price_up"),
        C.rescale_decimal(tax, 18, 1).alias("tax_up"),
    )


@query(
    """SELECT l_orderkey, l_linenumber,
              CAST(ceil(CAST(l_extendedprice * l_tax AS DECIMAL(18, 4)) * 100) / 100 AS DECIMAL(12, 2)) AS tax FROM lineitem"""
)
def csv_decimals_lineitem(t):
    path = t.path("decimals")
    tax = (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,4)")
    write_csv(t["lineitem"].select("l_orderkey", "l_linenumber", tax.alias("tax")), path)
    return read_csv(t.spark, path, {"l_orderkey": "int64", "l_linenumber": "int32", "tax": "decimal(12,2)"})


@query("SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events")
def ts_millis_events(t):
    return t["events"].select("event_id", C.ntz_to_millis(F.col("ts")).alias("ts"))


@query(
    """SELECT event_id, epoch_us(ts) // 1000000 AS seconds, CAST(epoch_us(ts) % 1000000 * 1000 AS INTEGER) AS nanos,
              make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_ms,
              make_timestamp(epoch_us(ts)) AS from_ns,
              make_timestamp(epoch_us(ts) // 1000000 * 1000000) + INTERVAL 8 HOUR AS in_zone FROM events"""
)
def epoch_units_events(t):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    split = C.split_epoch(micros, "us")
    return t["events"].select(
        "event_id",
        split["seconds"].alias("seconds"),
        split["nanos"].alias("nanos"),
        C.epoch_to_timestamp(F.floor(micros / 1000), "ms").cast("timestamp_ntz").alias("from_ms"),
        C.epoch_to_timestamp(micros * 1000, "ns").cast("timestamp_ntz").alias("from_ns"),
        C.epoch_to_timestamp(split["seconds"], "s", "Asia/Shanghai").cast("timestamp_ntz").alias("in_zone"),
    )


@query(
    """SELECT event_id, epoch_us(ts) % 86400000000 // 1000 AS ms, epoch_us(ts) % 86400000000 // 1000 * 1000000 AS ns,
              epoch_us(ts) % 86400000000 // 1000000 AS s FROM events"""
)
def time_of_day_events(t):
    ms = C.time_of_day_millis(F.col("ts"))
    return t["events"].select(
        "event_id", ms.alias("ms"), C.rescale_time(ms, "ms", "ns").alias("ns"), C.rescale_time(ms, "ms", "s").alias("s")
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, 1 AS n_keys FROM events")
def json_map_events(t):
    parsed = C.json_to_map(F.col("props"))
    return t["events"].select("event_id", parsed["k"].alias("k"), F.size(parsed).alias("n_keys"))


@query(
    """SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '","t":'
              || CASE WHEN event_type = 'error' THEN 'null' ELSE '"' || event_type || '"' END || '}' AS props,
              json_extract_string(props, '$.k') AS k FROM events"""
)
def map_json_roundtrip_events(t):
    path = t.path("maps")
    member = F.create_map(F.lit("t"), F.nullif("event_type", F.lit("error")))
    rows = t["events"].select("event_id", F.map_concat(C.json_to_map(F.col("props")), member).alias("props"))
    write_csv(rows, path)
    back = read_csv(t.spark, path, {"event_id": "int64", "props": "map<string,string>"})
    return back.select("event_id", C.map_to_json(F.col("props")).alias("props"), F.col("props")["k"].alias("k"))


@query(f"SELECT vec_id, label, {ELEMENTS_SQL} AS elements FROM embeddings")
def array_roundtrip_embeddings(t):
    path = t.path("arrays")
    write_csv(t["embeddings"], path)
    back = read_csv(t.spark, path, t["embeddings"].schema)
    return back.select("vec_id", "label", elements("embedding").alias("elements"))


@query(
    """SELECT doc_id, '''' || replace(replace(text, '\\', '\\\\'), '''', '''''') || '''' AS text_literal,
              CAST(n_chars AS VARCHAR) AS number_literal,
              CASE WHEN n_chars % 2 = 0 THEN 'true' ELSE 'false' END AS bool_literal FROM documents"""
)
def sql_literal_documents(t):
    return t["documents"].select(
        "doc_id",
        C.sql_literal(F.col("text"), T.StringType()).alias("text_literal"),
        C.sql_literal(F.col("n_chars"), T.LongType()).alias("number_literal"),
        C.sql_literal(F.col("n_chars") % 2 == 0, T.BooleanType()).alias("bool_literal"),
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS DECIMAL(12, 2)) AS quantity,
              CAST(l_partkey AS VARCHAR) AS part FROM lineitem"""
)
def recast_lineitem(t):
    return t["lineitem"].select(
        "l_orderkey",
        C.recast(F.col("l_linenumber"), "bigint").alias("line"),
        C.recast(F.col("l_quantity"), "decimal(12,2)").alias("quantity"),
        C.recast(F.col("l_partkey"), "string").alias("part"),
    )


@query("SELECT doc_id, md5(text) AS digest, octet_length(encode(text))::INTEGER AS n_bytes FROM documents")
def text_bytes_documents(t):
    data = C.utf8_bytes(F.col("text"))
    return t["documents"].select(
        "doc_id", F.md5(C.utf8_text(data)).alias("digest"), F.octet_length(data).alias("n_bytes")
    )
