import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.errors import (
    InvalidParameterError,
    InvalidPartitionSpecError,
    MissingFieldError,
    SourceUnavailableError,
)
from quayline.plans import (
    DatasetCatalog,
    acks_by_file,
    check_source,
    check_upload,
    copy_dataset,
    infer_schema,
    publish_dataset,
    read_dataset,
    write_dataset,
)
from quayline.plans.transfer import BINARY_SCHEMA
from quayline.refs import CsvFormat, DatasetRef, SourceRef
from quayline.sinks.orc import write_orc
from quayline.sinks.warehouse import create_table, write_partitions, write_table
from quayline.sources.csv import stream_csv
from quayline.sources.orc import read_columnar
from quayline.sources.warehouse import partition_columns, read_table
from quayline.streaming.transfer import acknowledged, stream_copy


@pytest.fixture
def xyz(spark):
    """Three small integer columns, seeded."""
    rng = random.Random(7)
    return spark.createDataFrame([tuple(rng.randint(0, 12) for _ in range(3)) for _ in range(10)], "x long, y long, z long")


@pytest.fixture
def source(tmp_path):
    return SourceRef("localfs", id="disk", path=str(tmp_path))


@pytest.fixture
def name():
    return f"t_{random.SystemRandom().randrange(10**12)}"


def same(a, b):
    return a.schema == b.schema and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
def test_round_trip_and_projection(spark, xyz, source, fmt):
    ref = DatasetRef.of(source, "d", xyz.schema, file_format=fmt)
    assert write_dataset(xyz, ref).rows == 10
    assert same(read_dataset(spark, ref), xyz)
    assert same(read_dataset(spark, ref, ["z"]), xyz.select("z"))
    assert read_dataset(spark, ref, limit=4).count() == 4
    assert same(read_dataset(spark, ref, ["z"], where="x > 3"), xyz.where("x > 3").select("z"))
    with pytest.raises(MissingFieldError):
        read_dataset(spark, ref, ["a"])
    with pytest.raises(MissingFieldError):
        read_dataset(spark, DatasetRef.of(source, "d", {"a": "int64"}, file_format=fmt))


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
def test_empty_keeps_schema(spark, xyz, source, fmt):
    ref = DatasetRef.of(source, "d", xyz.schema, file_format=fmt)
    assert write_dataset(xyz.where("x < 0"), ref).rows == 0
    back = read_dataset(spark, ref)
    assert back.schema == xyz.schema and back.count() == 0


def test_write_replaces(spark, xyz, source):
    ref = DatasetRef.of(source, "d", xyz.schema)
    write_dataset(xyz, ref)
    write_dataset(xyz.limit(3), ref)
    assert read_dataset(spark, ref).count() == 3


def test_declared_schema_wins_else_inferred(spark, xyz, source):
    declared = DatasetRef.of(source, "d", {"x": "int32"})
    write_dataset(xyz, DatasetRef.of(source, "d"))
    assert infer_schema(spark, declared) == T.StructType.fromDDL("x int")
    assert infer_schema(spark, DatasetRef.of(source, "d")) == T.StructType.fromDDL("x string, y string, z string")
    assert infer_schema(spark, DatasetRef.of(source, "d", type="model", file_format="binary")) == BINARY_SCHEMA
    orc = DatasetRef.of(source, "o", file_format="orc")
    write_dataset(xyz, orc)
    assert infer_schema(spark, orc) == xyz.schema


@pytest.mark.parametrize("codec", ["uncompressed", "snappy", "GZIP", "zstd", "lz4", "lz4_frame", "lzo"])
def test_orc_codecs(spark, xyz, tmp_path, codec):
    write_orc(xyz, str(tmp_path / "o"), compression=codec)
    assert same(read_columnar(spark, str(tmp_path / "o")), xyz)


@pytest.mark.parametrize("codec", ["brotli", "bz2"])
def test_orc_codecs_refused(xyz, tmp_path, codec):
    with pytest.raises(InvalidParameterError):
        write_orc(xyz, str(tmp_path / "o"), compression=codec)


def test_orc_prunes_columns(spark, xyz, tmp_path):
    write_orc(xyz, str(tmp_path / "o"))
    plan = read_columnar(spark, str(tmp_path / "o"), columns=["z"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<z:bigint>" in plan


def test_copies(spark, xyz, source):
    a = DatasetRef.of(source, "a", xyz.schema)
    b = DatasetRef.of(source, "b", xyz.schema, file_format="orc")
    raw = DatasetRef.of(source, "raw", type="model", file_format="binary")
    write_dataset(xyz, a)
    assert copy_dataset(spark, a, b, compression="zstd").rows == 10
    assert same(read_dataset(spark, b), xyz)
    copy_dataset(spark, a, raw)
    assert same(read_dataset(spark, DatasetRef.of(source, "raw", xyz.schema)), xyz)
    some = copy_dataset(spark, b, DatasetRef.of(source, "c", {"z": "int64"}), columns=["z"])
    assert some.rows == 10


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
def test_a_dataset_is_not_written_onto_itself(spark, xyz, source, fmt):
    a = DatasetRef.of(source, "a b%", xyz.schema, file_format=fmt)
    write_dataset(xyz, a)
    with pytest.raises(InvalidParameterError, match="is read by the rows"):
        copy_dataset(spark, a, a)
    with pytest.raises(InvalidParameterError, match="is read by the rows"):
        write_dataset(read_dataset(spark, a, where="x is null or true").limit(3), a)
    raw = DatasetRef.of(source, "a b%", type="model", file_format="binary")
    with pytest.raises(InvalidParameterError, match="is read by the rows"):
        copy_dataset(spark, a, raw)
    assert same(read_dataset(spark, a), xyz)


def test_failed_write_in_the_middle_leaves_nothing_published(spark, xyz, source):
    last = xyz.coalesce(1).collect()[-1].z
    stop = xyz.coalesce(1).withColumn("z", F.when(F.col("z") == last, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("z")))
    ref = DatasetRef.of(source, "p", xyz.schema, id="broken_publish")
    catalog = DatasetCatalog(spark)
    with pytest.raises(Exception):
        publish_dataset(stop, ref, catalog, max_records_per_file=1)
    assert not catalog.exists("broken_publish")
    assert [f for _, _, files in os.walk(source.path + "/p") for f in files] == []


def test_bytes_take_filter_columns_and_limit(spark, xyz, source):
    a = DatasetRef.of(source, "a", xyz.schema)
    write_dataset(xyz.repartition(3), a)
    assert read_dataset(spark, a, content_type="raw", limit=0).count() == 0
    assert read_dataset(spark, a, content_type="raw", where="1 = 0").count() == 0
    assert read_dataset(spark, a, ["chunk_no"], content_type="raw", where="chunk_no = 0").columns == ["chunk_no"]


def test_arguments_without_effect_are_refused(spark, xyz, source):
    a = DatasetRef.of(source, "a", xyz.schema)
    raw = DatasetRef.of(source, "raw", type="model", file_format="binary")
    write_dataset(xyz, a)
    for content in ("table", "raw", "csv"):
        with pytest.raises(InvalidParameterError):
            read_dataset(spark, a, content_type=content, partition_spec="dt=1")
    with pytest.raises(InvalidParameterError):
        write_dataset(xyz, DatasetRef.of(source, "b", xyz.schema), partition_spec="dt=1")
    for bad in ({"columns": ["x"]}, {"partition_spec": "dt=1"}, {"slice_bytes": 10}, {"target_partition_spec": "dt=1"}):
        with pytest.raises(InvalidParameterError):
            copy_dataset(spark, a, raw, **bad)


def test_slices_hold_their_size(spark, source, tmp_path):
    narrow = spark.range(200).select("id", F.lit("n").alias("t"))
    wide = spark.range(20).select("id", F.repeat(F.lit("w"), 5000).alias("t"))
    df = narrow.union(wide).coalesce(1)
    a = DatasetRef.of(source, "a", df.schema, file_format="orc")
    write_dataset(df, a)
    copy_dataset(spark, a, DatasetRef.of(source, "s", df.schema), slice_bytes=12_000)
    sizes = [os.path.getsize(tmp_path / "s" / f) for f in os.listdir(tmp_path / "s") if f.startswith("part")]
    # Ten files of two wide rows, the first with all the narrow ones.
    assert max(sizes) <= 12_000 and len(sizes) == 10
    back = read_dataset(spark, DatasetRef.of(source, "s", df.schema))
    assert back.count() == 220 and back.exceptAll(df).count() == 0


def test_slices(spark, xyz, source, tmp_path):
    a = DatasetRef.of(source, "a", xyz.schema)
    write_dataset(xyz.coalesce(1), a)
    for fmt in ("csv", "orc", "parquet"):
        # A header and four lines of text, or four rows of three numbers.
        bound = 4 * 9 + 12 if fmt == "csv" else 24 * 4
        copy_dataset(spark, a, DatasetRef.of(source, fmt, xyz.schema, file_format=fmt), slice_bytes=bound)
        sizes = [os.path.getsize(tmp_path / fmt / f) for f in os.listdir(tmp_path / fmt) if f.startswith("part")]
        assert max(sizes) <= bound and len(sizes) > 1 if fmt == "csv" else len(sizes) == 3


def test_bytes_of_any_file_format_and_resources(spark, xyz, source, tmp_path):
    stored = DatasetRef.of(source, "o", xyz.schema, file_format="orc")
    write_dataset(xyz, stored)
    raw = DatasetRef(source, "raw", "model", "binary")
    copy_dataset(spark, stored, raw)
    assert same(read_columnar(spark, str(tmp_path / "raw")), xyz)
    resource = DatasetRef(SourceRef("warehouse", path=str(tmp_path)), "res", "model", "binary")
    copy_dataset(spark, raw, resource)
    assert same(read_columnar(spark, str(tmp_path / "res")), xyz)
    back = DatasetRef(source, "back", "model", "binary")
    copy_dataset(spark, resource, back)
    assert same(read_columnar(spark, str(tmp_path / "back")), xyz)
    with pytest.raises(InvalidParameterError):
        copy_dataset(spark, DatasetRef(SourceRef("warehouse"), "t"), raw)


def test_publish_slices(spark, xyz, source, name):
    catalog = DatasetCatalog(spark)
    ref = DatasetRef.of(source, "d", xyz.schema, file_format="orc", id=name)
    publish_dataset(xyz.coalesce(1), ref, catalog, slice_bytes=24 * 5)
    assert len(catalog.read(name).inputFiles()) == 2


def test_csv_and_raw_content(spark, xyz, source):
    ref = DatasetRef.of(source, "d", xyz.schema)
    write_dataset(xyz, ref)
    lines = {r.line for r in read_dataset(spark, ref, content_type="csv").collect()}
    assert lines == {f"{r.x},{r.y},{r.z}" for r in xyz.collect()}
    raw = read_dataset(spark, ref, content_type="raw")
    assert raw.columns == ["path", "chunk_no", "binary_data"]
    assert b"x,y,z\n" in bytes(raw.first().binary_data)


def test_acks(spark, xyz, source):
    ref = DatasetRef.of(source, "d", xyz.schema, file_format="parquet")
    result = write_dataset(xyz.repartition(3), ref)
    acks = acks_by_file(spark.read.parquet(result.location)).collect()
    assert sum(a.row_count for a in acks) == result.rows == 10


def test_check_source(spark, source):
    assert check_source(spark, source)
    assert check_source(spark, SourceRef("warehouse"))
    with pytest.raises(SourceUnavailableError):
        check_source(spark, SourceRef("localfs", path="/no/such/place"))


def test_upload_checks(source):
    check_upload(DatasetRef.of(source, "d", {"a": "int64"}))
    check_upload(DatasetRef.of(source, "d", type="model"))
    for bad in (DatasetRef.of(source, "d"), DatasetRef.of(source, "d", type="report")):
        with pytest.raises(InvalidParameterError):
            check_upload(bad)


def test_catalog(spark, xyz, source, name):
    catalog = DatasetCatalog(spark)
    ref = DatasetRef.of(source, "d", {"x": "int64", "y": "bool", "z": "date32"}, id=name, name="n", vendor="v")
    rows = xyz.select("x", (F.col("y") > 3).alias("y"), F.date_from_unix_date(F.col("z").cast("int")).alias("z"))
    publish_dataset(rows, ref, catalog)
    assert same(catalog.read(name), rows)
    assert catalog.get(name)["vendor"] == "v" and name in catalog.ids()
    catalog.update(name, vendor="w")
    assert catalog.get(name)["vendor"] == "w"
    for bad in ({"colour": "red"}, {"location": "/x"}):
        with pytest.raises(InvalidParameterError):
            catalog.update(name, **bad)
    with pytest.raises(InvalidParameterError):
        publish_dataset(rows, ref, catalog)
    location = catalog.get(name)["location"].removeprefix("file://")
    catalog.delete(name)
    assert not catalog.exists(name) and os.path.isdir(location)
    with pytest.raises(MissingFieldError):
        catalog.read(name)


def test_catalog_keeps_the_dialect(spark, xyz, source, name):
    catalog = DatasetCatalog(spark)
    fmt = CsvFormat(separator=";", field_map={"raw_x": "x"})
    publish_dataset(xyz, DatasetRef.of(source, "d", xyz.schema, id=name, csv=fmt), catalog)
    assert same(catalog.read(name), xyz)


def test_failed_publish_leaves_nothing(spark, xyz, source, tmp_path, name):
    catalog = DatasetCatalog(spark)
    broken = xyz.withColumn("z", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception):
        publish_dataset(broken, DatasetRef.of(source, "d", xyz.schema, file_format="orc", id=name), catalog)
    assert not catalog.exists(name)
    assert not os.path.exists(tmp_path / "d") or os.listdir(tmp_path / "d") == []


def test_warehouse_partitions(spark, tmp_path, name):
    df = spark.createDataFrame([(1, "a", "020"), (2, "b", "20")], "id long, v string, dt string")
    write_table(df.where("dt = '020'"), name, "dt=020", location=str(tmp_path / "w"))
    write_table(df.where("dt = '20'"), name, "dt=20")
    assert partition_columns(spark, name) == ["dt"]
    assert [r.id for r in read_table(spark, name, partition_spec="dt=020").collect()] == [1]
    write_table(df.where("dt = '20'").withColumn("v", F.lit("new")), name, "dt=20")
    assert sorted((r.id, r.v) for r in read_table(spark, name).collect()) == [(1, "a"), (2, "new")]
    write_table(df.where("id < 0"), name, "dt=020")
    assert [r.id for r in read_table(spark, name).collect()] == [2]
    for spec in (None, "", "other=1"):
        with pytest.raises(InvalidPartitionSpecError):
            write_table(df, name, spec, create=False)


def test_dynamic_partitions_leave_others(spark, tmp_path, name):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, p string")
    create_table(spark, name, df.schema, "p=x", str(tmp_path / "w"))
    write_partitions(df, name)
    write_partitions(df.where("p = 'b'").withColumn("id", F.lit(20)), name)
    assert sorted((r.id, r.p) for r in read_table(spark, name).collect()) == [(1, "a"), (3, "c"), (20, "b")]


def test_unpartitioned_table_ignores_the_spec(spark, tmp_path, name):
    df = spark.createDataFrame([(1, None)], "id long, d date")
    write_table(df, name, location=str(tmp_path / "w"))
    assert read_table(spark, name, ["id"], partition_spec="dt=1").count() == 1
    wanted = T.StructType.fromDDL("ID string, missing double")
    assert tuple(read_table(spark, name, schema=wanted).first()) == ("1", None)
    with pytest.raises(InvalidPartitionSpecError):
        read_table(spark, "t; drop")


def test_warehouse_dataset(spark, xyz, tmp_path, name):
    ref = DatasetRef.of(SourceRef("odps"), name, xyz.schema)
    assert write_dataset(xyz, ref, partition_spec="dt=1", location=str(tmp_path / "w")).rows == 10
    assert same(read_dataset(spark, ref, partition_spec="dt=1"), xyz)
    assert read_dataset(spark, ref, ["z"], partition_spec="dt=2").count() == 0


def test_resources(spark, tmp_path):
    ref = DatasetRef(SourceRef("warehouse", path=str(tmp_path)), "res", "model", "binary")
    df = spark.createDataFrame([("a", 0, b"1"), ("a", 1, b"2"), ("b", 0, b"3")], "name string, chunk_no int, binary_data binary")
    assert write_dataset(df, ref).rows == 3
    assert (tmp_path / "res" / "a").read_bytes() == b"12"
    assert read_dataset(spark, ref).count() == 2


def test_stream_resumes_without_repeating(spark, xyz, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    heard = []
    xyz.repartition(4).write.parquet(source)
    args = dict(checkpoint=mark, files_per_batch=2, on_ack=heard.append)
    first = stream_copy(spark, source, xyz.schema, target, **args).wait()
    assert sum(a.row_count for a in first.acks) == 10 and heard == list(first.acks)
    xyz.write.mode("append").parquet(source)
    second = stream_copy(spark, source, xyz.schema, target, **args).wait()
    assert sum(a.row_count for a in second.acks) == 10
    assert min(a.batch_id for a in second.acks) > max(a.batch_id for a in first.acks)
    stored = acknowledged(spark, target)
    assert sorted(map(tuple, stored.collect())) == [(a.batch_id, a.row_count) for a in [*first.acks, *second.acks]]


def test_stream_of_csv(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.csv").write_text("raw_id,extra,ok,day\n1,x,TRUE,0\n2,y,0,19000\n")
    (source / "b.csv").write_text("raw_id,extra,ok,day\n3,z,,\n")
    fmt = CsvFormat(field_map={"raw_id": "id"})
    arriving = stream_csv(
        spark, str(source), {"id": "uint8", "day": "date32", "ok": "bool"}, ["raw_id", "extra", "ok", "day"], fmt
    )
    stream_copy(spark, arriving, None, target).wait()
    rows = spark.read.parquet(target).orderBy("id").collect()
    assert [(r.id, str(r.day), r.ok) for r in rows] == [(1, "1970-01-01", True), (2, "2022-01-08", False), (3, "None", None)]
    (source / "c.csv").write_text("extra,raw_id,ok,day\n4,z,,\n")
    with pytest.raises(Exception):
        stream_copy(spark, arriving, None, str(tmp_path / "other")).wait()


@pytest.mark.parametrize("fmt", ["csv", "orc"])
def test_stream_into_other_formats(spark, xyz, tmp_path, fmt):
    xyz.write.parquet(str(tmp_path / "in"))
    stream_copy(spark, str(tmp_path / "in"), xyz.schema, str(tmp_path / "out"), target_format=fmt).wait()
    assert [tuple(r) for r in acknowledged(spark, str(tmp_path / "out")).collect()] == [(0, 10)]
    ref = DatasetRef.of(SourceRef("localfs", path=str(tmp_path)), "out/batch_id=0", xyz.schema, file_format=fmt)
    assert same(read_dataset(spark, ref), xyz)


def test_stream_can_be_cancelled(spark, xyz, tmp_path):
    xyz.write.parquet(str(tmp_path / "in"))
    running = stream_copy(spark, str(tmp_path / "in"), xyz.schema, str(tmp_path / "out"), continuous="1 second")
    running.query.processAllAvailable()
    running.cancel()
    assert not running.query.isActive and [a.row_count for a in running.acks] == [10]
