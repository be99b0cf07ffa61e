"""Files as bytes over the given tables."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayline.plans import copy_dataset, read_dataset, write_dataset
from quayline.refs import DatasetRef
from quayline.sinks.binary import write_binary
from quayline.sinks.csv import write_csv
from quayline.sinks.warehouse import write_resource
from quayline.sources.binary import CLIENT_CHUNK, read_binary
from quayline.sources.csv import read_csv
from quayline.sources.jdbc import index_profile
from quayline.sources.warehouse import read_resource
from quayline.workloads.registry import query


def _base_name(path="path"):
    return F.element_at(F.split(path, "/"), -1)


# Pages are gathered into this many files, however many there are.
_BLOBS = 16


def _page_files(t):
    path = t.path("pages")
    blobs = t["pages"].select(
        F.concat((F.col("page_id") % _BLOBS).cast("string"), F.lit(".html")).alias("name"),
        F.col("page_id").alias("chunk_no"),
        F.encode("html", "UTF-8").alias("binary_data"),
    )
    write_binary(blobs, path)
    return path


def _chunks(rows, suffix):
    return rows.select(
        F.regexp_replace(_base_name(), suffix, "").cast("bigint").alias("blob"),
        "chunk_no",
        F.octet_length("binary_data").alias("n_bytes"),
        F.md5("binary_data").alias("digest"),
    )


_PAGE_CHUNKS = """
    SELECT blob, c AS chunk_no, octet_length(b[c * {n} + 1 : (c + 1) * {n}])::INTEGER AS n_bytes,
           md5(b[c * {n} + 1 : (c + 1) * {n}]) AS digest
    FROM (SELECT page_id % 16 AS blob, encode(string_agg(html, '' ORDER BY page_id)) AS b FROM pages GROUP BY 1) p, LATERAL (
        SELECT unnest(generate_series(0, ((octet_length(p.b) + {n} - 1) // {n}) - 1)) AS c) AS s
"""


@query(_PAGE_CHUNKS.format(n=4096))
def binary_chunks_pages(t):
    return _chunks(read_binary(t.spark, _page_files(t), chunk_bytes=4096), r"\.html$")


@query(_PAGE_CHUNKS.format(n=2000))
def binary_ranges_pages(t):
    # A small inline limit sends the files through the byte-range reader.
    rows = read_binary(t.spark, _page_files(t), chunk_bytes=2000, inline_bytes=2500, range_bytes=4000)
    return _chunks(rows, r"\.html$")


@query(_PAGE_CHUNKS.format(n=1024))
def resource_chunks_pages(t):
    return _chunks(read_resource(t.spark, _page_files(t)), r"\.html$")


@query(_PAGE_CHUNKS.format(n=4096))
def binary_concat_pages(t):
    path = t.path("pages")
    # Three chunks per page, in one stream per file.
    size = F.ceil(F.octet_length(F.col("html").cast("binary")) / 3).cast("int")
    pieces = t["pages"].select(
        F.concat((F.col("page_id") % _BLOBS).cast("string"), F.lit(".html")).alias("name"),
        "page_id",
        F.explode(F.sequence(F.lit(0), F.lit(2))).alias("piece"),
        F.col("html").cast("binary").alias("b"),
        size.alias("size"),
    )
    chunks = pieces.select(
        "name",
        (F.col("page_id") * 3 + F.col("piece")).alias("chunk_no"),
        F.substring("b", F.col("piece") * F.col("size") + 1, F.col("size")).alias("binary_data"),
    )
    write_binary(chunks, path, layout="stream")
    return _chunks(read_binary(t.spark, path, chunk_bytes=4096), r"\.html$")


@query(
    """WITH blobs AS (SELECT source, encode(string_agg(text, '' ORDER BY doc_id)) AS b FROM documents GROUP BY source)
       SELECT source, c AS chunk_no, octet_length(b[c * 65536 + 1 : (c + 1) * 65536])::INTEGER AS n_bytes,
              md5(b[c * 65536 + 1 : (c + 1) * 65536]) AS digest
       FROM blobs, LATERAL (
           SELECT unnest(generate_series(0, ((octet_length(blobs.b) + 65535) // 65536) - 1)) AS c) AS s"""
)
def binary_concat_documents(t):
    path = t.path("sources")
    texts = t["documents"].select(
        F.col("source").alias("name"),
        F.col("doc_id").alias("chunk_no"),
        F.encode("text", "UTF-8").alias("binary_data"),
    )
    write_binary(texts, path)
    rows = read_binary(t.spark, path, chunk_bytes=65536)
    return rows.select(
        _base_name().alias("source"),
        "chunk_no",
        F.octet_length("binary_data").alias("n_bytes"),
        F.md5("binary_data").alias("digest"),
    )


@query("SELECT * FROM orders")
def raw_csv_copy_orders(t):
    stored = DatasetRef.of(t.source(), t.relative("orders"), t["orders"].schema)
    write_dataset(t["orders"], stored)
    copied = DatasetRef.of(t.source(), t.relative("raw"), type="model", file_format="binary")
    copy_dataset(t.spark, stored, copied)
    return read_csv(t.spark, t.source().uri(copied.relative_uri), t["orders"].schema)


@query("SELECT concat_ws(',', p_partkey, p_name, p_brand) AS line FROM part")
def raw_csv_bytes_part(t):
    path = t.path("part")
    rows = t["part"].select("p_partkey", "p_name", "p_brand")
    ref = DatasetRef.of(t.source(), path.rsplit("/", 1)[1])
    write_csv(rows, path)
    raw = read_dataset(t.spark, ref, content_type="raw", chunk_bytes=65536)
    return _lines(raw, ",".join(rows.columns))


def _lines(raw, header):
    """Lines of chunked text files without their headers; chunks end anywhere, also in a line or a character.

    Lines within a chunk stay where they are. Only what stands before a chunk's
    first line break and after its last one meets its neighbours, line by line.
    """
    # One character a byte, so that a character cut in two survives.
    cut = raw.select("path", "chunk_no", F.split(F.decode("binary_data", "ISO-8859-1"), "\n").alias("pieces"))
    broken = F.size("pieces") > 1
    inner = cut.select(F.explode(F.slice("pieces", 2, F.greatest(F.size("pieces") - 2, F.lit(0)))).alias("line"))
    ends = cut.select("path", "chunk_no", broken.alias("broken"), F.element_at("pieces", 1).alias("head"), F.element_at("pieces", -1).alias("tail"))
    # A line is named by the chunk in which it begins, a file's first line by -1.
    so_far = W.partitionBy("path").orderBy("chunk_no").rowsBetween(W.unboundedPreceding, -1)
    begun = F.coalesce(F.max(F.when(F.col("broken"), F.col("chunk_no"))).over(so_far), F.lit(-1))
    ends = ends.withColumn("begun", begun.cast("bigint"))
    head = F.struct(F.col("begun"), F.col("head").alias("piece"))
    tail = F.struct(F.col("chunk_no").cast("bigint").alias("begun"), F.col("tail").alias("piece"))
    ends = ends.select("path", "chunk_no", F.explode(F.when(F.col("broken"), F.array(head, tail)).otherwise(F.array(head))).alias("end"))
    pieces = F.sort_array(F.collect_list(F.struct("chunk_no", "end.piece")))
    joined = ends.groupBy("path", F.col("end.begun").alias("begun")).agg(F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("line"))
    lines = inner.union(joined.select("line")).select(F.decode(F.encode("line", "ISO-8859-1"), "UTF-8").alias("line"))
    return lines.where((F.col("line") != "") & (F.col("line") != header))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 0 ELSE strlen(html) END AS n_bytes, CASE WHEN page_id % 3 = 0 THEN md5('') ELSE md5(html) END AS digest FROM pages")
def binary_copy_empty_pages(t):
    # Every third page is a file without a byte; it has to arrive as one.
    html = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.col("html"))
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    blobs = t["pages"].select(name.alias("name"), F.lit(0).alias("chunk_no"), F.encode(html, "UTF-8").alias("binary_data"))
    stored = DatasetRef.of(t.source(), t.relative("pages"), type="model", file_format="binary")
    write_dataset(blobs, stored, "raw")
    copied = DatasetRef.of(t.source(), t.relative("copied"), type="model", file_format="binary")
    copy_dataset(t.spark, stored, copied)
    rows = read_dataset(t.spark, copied)
    return rows.select(
        F.regexp_replace(_base_name(), r"\.html$", "").cast("bigint").alias("page_id"),
        F.octet_length("binary_data").cast("bigint").alias("n_bytes"),
        F.md5("binary_data").alias("digest"),
    )


_SOURCE_CHUNKS = """WITH blobs AS (SELECT source, encode(string_agg(text, '' ORDER BY {order})) AS b FROM documents GROUP BY source)
       SELECT source, c AS chunk_no, octet_length(b[c * {n} + 1 : (c + 1) * {n}])::INTEGER AS n_bytes,
              md5(b[c * {n} + 1 : (c + 1) * {n}]) AS digest
       FROM blobs, LATERAL (
           SELECT unnest(generate_series(0, ((octet_length(blobs.b) + {n} - 1) // {n}) - 1)) AS c) AS s"""


def _source_chunks(rows):
    return rows.select(
        _base_name().alias("source"),
        "chunk_no",
        F.octet_length("binary_data").alias("n_bytes"),
        F.md5("binary_data").alias("digest"),
    )


def _sources(t, order):
    return t["documents"].select(
        F.col("source").alias("name"), order.alias("chunk_no"), F.encode("text", "UTF-8").alias("binary_data")
    )


@query(_SOURCE_CHUNKS.format(n=65536, order="(doc_id * 2654435761) % 4294967296, doc_id"))
def binary_concat_hashed_documents(t):
    # Order numbers as sparse as hashes; the multiplier is odd, so they are distinct for ids below 2^32.
    path = t.path("sources")
    write_binary(_sources(t, (F.col("doc_id") * 2654435761) % 4294967296), path)
    return _source_chunks(read_binary(t.spark, path, chunk_bytes=65536))


@query("SELECT source, sum(strlen(text))::BIGINT AS n_bytes FROM documents GROUP BY source")
def binary_concat_equal_order_documents(t):
    # Equal order numbers leave the order open, but every byte has its place.
    path = t.path("sources")
    write_binary(_sources(t, F.lit(7)), path)
    rows = read_binary(t.spark, path)
    return rows.groupBy(_base_name().alias("source")).agg(F.sum(F.octet_length("binary_data")).cast("bigint").alias("n_bytes"))


@query(_SOURCE_CHUNKS.format(n=131072, order="doc_id"))
def client_chunks_documents(t):
    path = t.path("sources")
    write_binary(_sources(t, F.col("doc_id")), path)
    return _source_chunks(read_binary(t.spark, path, chunk_bytes=CLIENT_CHUNK))


@query(_SOURCE_CHUNKS.format(n=1024, order="doc_id"))
def resource_write_documents(t):
    path = t.path("resources")
    write_resource(_sources(t, F.col("doc_id")), path)
    return _source_chunks(read_resource(t.spark, path))


@query("SELECT * FROM part")
def raw_into_csv_part(t):
    # The bytes of one CSV dataset written as another's files.
    stored = DatasetRef.of(t.source(), t.relative("part"), t["part"].schema)
    write_dataset(t["part"], stored)
    raw = read_dataset(t.spark, stored, content_type="raw")
    target = DatasetRef.of(t.source(), t.relative("raw"), t["part"].schema)
    write_dataset(raw.withColumn("name", _base_name()), target, "raw")
    return read_dataset(t.spark, target)


@query("SELECT 'PRIMARY' AS index_name, TRUE AS is_unique, 'c0,c1' AS columns UNION ALL SELECT 'by_' || n_name, n_nationkey % 2 = 0, 'c0,c1,c2' FROM nation")
def index_profile_nation(t):
    # Index statistics as a database lists them, one index per nation, its columns in any order.
    seq = F.explode(F.array(*[F.lit(i) for i in (2, 0, 1)])).alias("seq")
    named = t["nation"].select(F.concat(F.lit("by_"), F.col("n_name")).alias("index_name"), (F.col("n_nationkey") % 2).cast("int").alias("non_unique"), seq)
    primary = t["nation"].where("n_nationkey = 0").select(
        F.lit("PRIMARY").alias("index_name"), F.lit(0).alias("non_unique"), F.explode(F.array(F.lit(1), F.lit(0))).alias("seq")
    )
    statistics = named.union(primary).withColumn("column_name", F.concat(F.lit("c"), F.col("seq").cast("string")))
    return index_profile(statistics).withColumn("columns", F.array_join("columns", ","))
