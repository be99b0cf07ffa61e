"""Whole-dataset operations over the given tables."""

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from quayline.plans import (
    DatasetCatalog,
    RegistryLog,
    acks_by_file,
    copy_dataset,
    publish_dataset,
    read_dataset,
    read_splits,
    write_dataset,
)
from quayline.operators.paging import row_bytes
from quayline.plans.splits import even_pieces
from quayline.refs import CsvFormat, DatasetRef, SourceRef
from quayline.sinks.csv import write_csv
from quayline.sinks.orc import write_orc
from quayline.sinks.warehouse import create_table
from quayline.sources import framing
from quayline.sources.csv import stream_csv
from quayline.sources.orc import read_columnar
from quayline.streaming.transfer import acknowledged, stream_copy
from quayline.workloads.registry import ELEMENTS_SQL, elements, query


@query("SELECT * FROM lineitem")
def orc_roundtrip_lineitem(t):
    path = t.path("lineitem")
    write_orc(t["lineitem"], path, compression="zstd")
    return read_columnar(t.spark, path)


@query("SELECT l_quantity, l_orderkey, l_shipdate FROM lineitem")
def orc_project_lineitem(t):
    path = t.path("lineitem")
    write_orc(t["lineitem"], path)
    return read_columnar(t.spark, path, columns=["l_quantity", "l_orderkey", "l_shipdate"])


@query(f"SELECT vec_id, label, {ELEMENTS_SQL} AS elements FROM embeddings")
def orc_arrays_embeddings(t):
    path = t.path("embeddings")
    write_orc(t["embeddings"], path, compression="snappy")
    return read_columnar(t.spark, path).select("vec_id", "label", elements("embedding").alias("elements"))


@query("SELECT * FROM orders WHERE o_orderkey < 0")
def empty_keeps_schema_orders(t):
    none = t["orders"].where("o_orderkey < 0")
    ref = DatasetRef.of(t.source(), t.relative("none"), none.schema)
    write_dataset(none, ref)
    orc = DatasetRef.of(t.source(), t.relative("none"), none.schema, file_format="orc")
    copy_dataset(t.spark, ref, orc)
    return read_columnar(t.spark, t.source().uri(orc.relative_uri))


@query("SELECT * FROM part")
def copy_csv_to_orc_part(t):
    part = t["part"]
    stored = DatasetRef.of(t.source(), t.relative("part"), part.schema)
    write_dataset(part, stored)
    target = DatasetRef.of(t.source(), t.relative("part"), part.schema, file_format="orc")
    copy_dataset(t.spark, stored, target, compression="gzip")
    return read_dataset(t.spark, target)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def copy_orc_to_csv_orders(t):
    orders = t["orders"]
    stored = DatasetRef.of(t.source(), t.relative("orders"), orders.schema, file_format="orc")
    write_dataset(orders, stored)
    kept = orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    target = DatasetRef.of(t.source(), t.relative("orders"), kept.schema)
    copy_dataset(t.spark, stored, target, columns=kept.columns)
    return read_dataset(t.spark, target)


@query("SELECT count(*) AS acknowledged, count(*) AS written, count(*) AS stored FROM lineitem")
def ack_row_counts_lineitem(t):
    lineitem = t["lineitem"]
    ref = DatasetRef.of(t.source(), t.relative("lineitem"), lineitem.schema, file_format="parquet")
    result = write_dataset(lineitem, ref)
    acks = acks_by_file(t.spark.read.parquet(result.location))
    return acks.agg(F.sum("row_count").alias("acknowledged")).select(
        "acknowledged",
        F.lit(result.rows).cast("bigint").alias("written"),
        F.lit(t.spark.read.parquet(result.location).count()).cast("bigint").alias("stored"),
    )


@query("SELECT * FROM events")
def publish_events(t):
    rows = t["events"]
    catalog = DatasetCatalog(t.spark)
    good = f"events_{uuid.uuid4().hex}"
    ref = DatasetRef.of(t.source(), t.relative("published"), rows.schema, file_format="orc", id=good)
    publish_dataset(rows, ref, catalog)
    return catalog.read(good)


@query("SELECT count(*) AS row_count, FALSE AS registered, FALSE AS files_left, TRUE AS failed FROM events")
def publish_rollback_events(t):
    catalog = DatasetCatalog(t.spark)
    events, last = t["events"], t["events"].agg(F.max("event_id")).first()[0]
    stop = F.raise_error(F.lit("the source breaks off")).cast("bigint")
    # The last event fails, when the files before it are already written.
    rows = events.withColumn("event_id", F.when(F.col("event_id") == last, stop).otherwise(F.col("event_id")))
    bad = f"events_{uuid.uuid4().hex}"
    ref = DatasetRef.of(t.source(), t.relative("rolled"), events.schema, id=bad)
    try:
        publish_dataset(rows, ref, catalog, max_records_per_file=max(1, events.count() // 10))
        failed = False
    except Exception:
        failed = True
    folder = t.source().uri(ref.relative_uri)
    left = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).limit(1).count() > 0
    return events.agg(F.count(F.lit(1)).alias("row_count")).withColumns(
        {"registered": F.lit(catalog.exists(bad)), "files_left": F.lit(left), "failed": F.lit(failed)}
    )


@query(
    """SELECT c_custkey, c_acctbal > 0 AS in_credit,
              CAST(DATE '2020-01-01' + CAST(c_custkey % 100 AS INTEGER) AS DATE) AS since FROM customer"""
)
def catalog_read_customer(t):
    rows = t["customer"].select(
        "c_custkey",
        (F.col("c_acctbal") > 0).alias("in_credit"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 100).cast("int")).alias("since"),
    )
    catalog = DatasetCatalog(t.spark)
    name = f"customer_{uuid.uuid4().hex}"
    ref = DatasetRef.of(t.source(), t.relative("customer"), rows.schema, id=name, name="customers")
    publish_dataset(rows, ref, catalog)
    catalog.update(name, vendor="shared")
    return catalog.read(name)


def _streamed(t):
    source, target = t.path("arriving"), t.path("delivered")
    events = t["events"]
    # At least nine files, whatever the number of write tasks, delivered in three batches.
    per_file = max(1, events.count() // 9)
    events.write.option("maxRecordsPerFile", per_file).parquet(source)
    files = len(t.spark.read.schema(events.schema).parquet(source).inputFiles())
    stream_copy(t.spark, source, events.schema, target, files_per_batch=-(-files // 3)).wait()
    return target


@query("SELECT * FROM events")
def stream_copy_events(t):
    return t.spark.read.parquet(_streamed(t)).drop("batch_id")


@query("SELECT count(*) AS row_count, 3 AS batches FROM events")
def stream_acks_events(t):
    acks = acknowledged(t.spark, _streamed(t))
    return acks.agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).cast("int").alias("batches"))


@query("SELECT o_orderkey, o_orderdate, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders")
def stream_csv_orders(t):
    source, target = t.path("arriving"), t.path("delivered")
    orders = t["orders"].select("o_orderkey", "o_orderdate", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    write_csv(orders, source, max_records_per_file=200_000)
    stream_copy(t.spark, stream_csv(t.spark, source, orders.schema), None, target).wait()
    return t.spark.read.parquet(target).drop("batch_id")


_EVERY_TYPE = {
    "tinyint": ("(event_id % 128)", "TINYINT"),
    "smallint": ("(event_id % 32768)", "SMALLINT"),
    "int": ("(event_id % 1000000)", "INTEGER"),
    "bigint": ("event_id", "BIGINT"),
    "float4": ("(event_id % 1000) / 8", "FLOAT"),
    "double": ("value", "DOUBLE"),
    "bool": ("event_id % 2 = 0", "BOOLEAN"),
    "string": ("event_type", "VARCHAR"),
}


@query(
    "SELECT event_id, "
    + ", ".join(
        f"CASE WHEN event_id % 5 <> 0 THEN CAST({e} AS {kind}) END AS \"{n}\"" for n, (e, kind) in _EVERY_TYPE.items()
    )
    + ", CASE WHEN event_id % 5 <> 0 THEN md5('binary_' || event_id) END AS \"binary\" FROM events"
)
def all_types_roundtrip_events(t):
    some = F.col("event_id") % 5 != 0
    spark_names = {"VARCHAR": "STRING", "INTEGER": "INT"}
    rows = t["events"].select(
        "event_id",
        *[
            F.when(some, F.expr(f"CAST({e} AS {spark_names.get(kind, kind)})")).alias(n)
            for n, (e, kind) in _EVERY_TYPE.items()
        ],
        F.when(some, F.encode(F.concat(F.lit("binary_"), F.col("event_id").cast("string")), "UTF-8")).alias("binary"),
    )
    ref = DatasetRef.of(t.source(), t.relative("types"), rows.schema)
    write_dataset(rows, ref)
    return read_dataset(t.spark, ref).withColumn("binary", F.md5("binary"))


@query("SELECT * FROM part")
def copy_sliced_part(t):
    stored = DatasetRef.of(t.source(), t.relative("part"), t["part"].schema, file_format="parquet")
    write_dataset(t["part"], stored)
    target = DatasetRef.of(t.source(), t.relative("slices"), t["part"].schema)
    copy_dataset(t.spark, stored, target, slice_bytes=SLICE_BYTES)
    return read_dataset(t.spark, target)


SLICE_BYTES = 64 * 1024


@query("SELECT count(*) AS row_count, TRUE AS within_bound, TRUE AS several FROM documents")
def slice_bound_documents(t):
    # Narrow rows first, wide ones last: their widths differ a thousandfold.
    docs = t["documents"].select("doc_id", F.translate("text", "\r\n", "  ").alias("text")).orderBy(F.length("text"))
    stored = DatasetRef.of(t.source(), t.relative("documents"), docs.schema, file_format="orc")
    write_dataset(docs, stored)
    target = DatasetRef.of(t.source(), t.relative("slices"), docs.schema)
    # A slice holds one row at least, so the bound starts from the widest.
    bound = docs.agg(F.max(F.octet_length("text"))).first()[0] * 2 + 1024
    copy_dataset(t.spark, stored, target, slice_bytes=bound)
    files = t.spark.read.format("binaryFile").load(t.source().uri(target.relative_uri))
    sizes = files.agg((F.max("length") <= bound).alias("within_bound"), (F.count(F.lit(1)) > 1).alias("several"))
    return sizes.withColumn("row_count", F.lit(read_dataset(t.spark, target).count()).cast("bigint"))


@query("SELECT count(*) AS row_count, TRUE AS within_bound, TRUE AS full FROM documents")
def slice_fill_documents(t):
    """One row is far wider than the others: it costs its own file, all other files are filled to the bound."""
    docs = t["documents"].select("doc_id", F.translate("text", "\r\n", "  ").alias("text"))
    widest = docs.agg(F.max(F.octet_length("text"))).first()[0]
    # Wider than the bound by itself, a thousand times the mean and more.
    huge = docs.limit(1).select(F.lit(-1).cast("bigint").alias("doc_id"), F.repeat(F.lit("w"), 64 * widest).alias("text"))
    rows = docs.unionByName(huge).repartition(8)
    bound = 32 * widest
    ref = DatasetRef.of(t.source(), t.relative("slices"), rows.schema)
    write_dataset(rows, ref, slice_bytes=bound)
    files = t.spark.read.format("binaryFile").load(t.source().uri(ref.relative_uri)).select("path", "length")
    task = F.regexp_extract("path", r"part-(\d+)-(\d+)-", 1)
    number = F.regexp_extract("path", r"part-(\d+)-(\d+)-", 2).cast("int")
    placed = files.select("length", task.alias("task"), number.alias("number"))
    ends = placed.groupBy("task").agg(F.max("number").alias("last"))
    # What is missing in a file is less than the row that did not fit; quoted text is at most twice as long.
    room = placed.join(ends, "task").where("number < last and length <= " + str(bound)).select(F.lit(bound) - F.col("length") < 2 * widest + 64)
    before_huge = placed.where(F.col("length") > bound).count()
    short = room.where(~F.col(room.columns[0])).count()
    alone = read_dataset(t.spark, ref).where("doc_id >= 0").count()
    # The file before the huge row may be short, as the row fits into no file.
    checks = placed.agg((F.count_if(F.col("length") > bound) == 1).alias("within_bound"))
    return checks.select(F.lit(alone).cast("bigint").alias("row_count"), "within_bound", F.lit(short <= before_huge).alias("full"))


# Bytes of rows in each file that is split, so that a task writes no more however many there are.
_SPLIT_FILE = 64 * 1024 * 1024


@query("SELECT count(*) AS row_count, 7::BIGINT AS splits, TRUE AS even FROM documents")
def even_splits_documents(t):
    docs = t["documents"]
    ref = DatasetRef.of(t.source(), t.relative("documents"), docs.schema, csv=CsvFormat(encoding="UTF-8"))
    held = docs.agg(F.sum(row_bytes(docs.schema))).first()[0] or 0
    write_dataset(docs.repartition(max(3, -(-held // _SPLIT_FILE))), ref)
    rows = read_splits(t.spark, ref, 7, multiline=True)
    # Texts are compared whole, by their digests: they need not be shuffled for that.
    digest = F.sha2("text", 256)
    wanted = docs.select("doc_id", digest.alias("known"), (F.coalesce("text", F.lit("")) == "").alias("empty"))
    known = rows.select("doc_id", digest.alias("digest")).join(wanted, "doc_id", "left").where("digest = known or coalesce(empty, true)")
    files = framing.listed(t.spark, t.source().uri(ref.relative_uri))
    sizes = even_pieces(files, 7).groupBy("split").agg(F.sum(F.col("stop") - F.col("start")).alias("bytes"))
    even = sizes.agg((F.max("bytes") - F.min("bytes") <= 1).alias("even"))
    splits = F.lit(rows.rdd.getNumPartitions()).cast("bigint").alias("splits")
    return even.select(F.lit(known.count()).cast("bigint").alias("row_count"), splits, "even")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def even_splits_orders(t):
    ref = DatasetRef.of(t.source(), t.relative("orders"), t["orders"].schema)
    write_dataset(t["orders"], ref)
    return read_splits(t.spark, ref, 5, ["o_orderkey", "o_custkey", "o_totalprice"])


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS dataset_id, 2::BIGINT AS version FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, 1::BIGINT FROM orders WHERE o_orderstatus = 'P'"""
)
def registry_by_source_orders(t):
    """A dataset for each order status in one of two sources; all that a source has are found by its id and read."""
    log = RegistryLog(t.spark, t.path("registry"))
    root = t.source()
    for source in ("open", "done"):
        log.create_source(SourceRef("localfs", id=source, path=f"{root.path}/{t.relative(source)}"))
    rows = t["orders"].select("o_orderkey", "o_totalprice")
    for (status,) in t["orders"].select("o_orderstatus").distinct().collect():
        ref = DatasetRef.of(log.source("open" if status == "P" else "done"), f"orders_{status}", rows.schema, file_format="orc", id=status)
        write_dataset(t["orders"].where(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice"), ref)
        log.create_dataset(ref)
    for ref in log.datasets_of("done"):
        log.update_dataset(replace(ref, name=f"orders of status {ref.id}"), known=1)
    parts = []
    for source in ("open", "done"):
        known = log.datasets(source).select(F.col("id").alias("dataset_id"), "version")
        for ref in log.datasets_of(source):
            parts.append(read_dataset(t.spark, ref).withColumn("dataset_id", F.lit(ref.id)).join(F.broadcast(known), "dataset_id"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("SELECT least(100, count(*)) AS row_count, least(100, count(*)) AS found FROM lineitem")
def limited_read_lineitem(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    ref = DatasetRef.of(t.source(), t.relative("lineitem"), t["lineitem"].schema, file_format="orc")
    write_dataset(t["lineitem"], ref)
    some = read_dataset(t.spark, ref, keys, limit=100)
    known = t["lineitem"].select(*keys, F.lit(1).cast("bigint").alias("known")).distinct()
    return some.join(known, keys, "left").agg(F.count(F.lit(1)).alias("row_count"), F.sum("known").alias("found"))


@query("SELECT o_orderkey, o_totalprice, '2024' AS dt FROM orders UNION ALL SELECT c_custkey, c_acctbal, '2023' FROM customer")
def copy_into_partition_orders(t):
    name = f"copied_{uuid.uuid4().hex}"
    rows = t["orders"].select("o_orderkey", "o_totalprice")
    create_table(t.spark, name, rows.schema, "dt=any", t.path("copied"))
    table = DatasetRef.of(SourceRef("odps"), name, file_format="table")
    other = t["customer"].select(F.col("c_custkey").alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice"))
    for frame, day in ((other, "2023"), (other, "2024"), (rows, "2024")):
        stored = DatasetRef.of(t.source(), t.relative("rows"), frame.schema, file_format="parquet")
        write_dataset(frame, stored)
        copy_dataset(t.spark, stored, table, target_partition_spec=f"dt={day}")
    return read_dataset(t.spark, table)
