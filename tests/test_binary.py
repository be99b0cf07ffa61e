import os

import pytest
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError, MissingFieldError
from quayline.sinks import binary
from quayline.sinks.binary import merge_files, write_binary
from quayline.sources import filesystem
from quayline.sources.binary import CLIENT_CHUNK, arrow_options, open_filesystem, read_binary, s3_options
from quayline.sources.warehouse import read_resource

BIG = os.urandom(5 * 1024 * 1024 + 7)
NULS = bytes([0x33, 0, 0, 0x34, 0x35, 0, 0x36, 0])


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    (source / "sub dir").mkdir(parents=True)
    (source / "big %20.bin").write_bytes(BIG)
    (source / "sub dir" / "nuls").write_bytes(NULS)
    (source / "empty").write_bytes(b"")
    return str(source)


binary_done = binary._done


def named(df, folder):
    return df.withColumn("name", F.substring("path", len("file:" + folder) + 2, 10_000))


@pytest.mark.parametrize("inline", [64 * 1024 * 1024, 1024])
@pytest.mark.parametrize("layout", ["offset", "stream"])
def test_copy_is_byte_exact(spark, folder, tmp_path, inline, layout):
    rows = named(read_binary(spark, folder, CLIENT_CHUNK, inline_bytes=inline, range_bytes=1024 * 1024), folder)
    target = str(tmp_path / "out")
    totals = write_binary(rows.repartition(7), target, layout=layout)
    assert totals == {"chunks": 43, "bytes": len(BIG) + len(NULS)}
    assert (tmp_path / "out" / "empty").read_bytes() == b""
    assert (tmp_path / "out" / "big %20.bin").read_bytes() == BIG
    assert (tmp_path / "out" / "sub dir" / "nuls").read_bytes() == NULS
    assert [f for f in os.listdir(tmp_path) if "staging" in f] == []


@pytest.mark.parametrize("inline", [64 * 1024 * 1024, 1024])
def test_chunks_are_numbered_and_full(spark, folder, inline):
    rows = read_binary(spark, folder + "/big*", 1_000_000, inline_bytes=inline).orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(6))
    assert b"".join(bytes(r.binary_data) for r in rows) == BIG
    assert all(len(r.binary_data) == 1_000_000 for r in rows[:-1])


def test_resource_chunks(spark, folder):
    sizes = {r[0] for r in read_resource(spark, folder + "/big*").select(F.octet_length("binary_data")).collect()}
    assert max(sizes) == 1024 and len(sizes) == 2


def test_write_replaces_and_skips_nulls(spark, tmp_path):
    target = tmp_path / "out"
    target.mkdir()
    (target / "old").write_bytes(b"old")
    df = spark.createDataFrame([("f", 2, b"c"), ("f", 0, b"a"), ("f", 1, None)], "name string, chunk_no int, binary_data binary")
    assert write_binary(df, str(target)) == {"chunks": 2, "bytes": 2}
    assert os.listdir(target) == ["f"] and (target / "f").read_bytes() == b"ac"


def test_repeated_chunk_numbers_keep_every_byte(spark, tmp_path):
    df = spark.createDataFrame([("f", 0, b"xx"), ("f", 0, b"xx"), ("f", -3, b"y")], "name string, chunk_no int, binary_data binary")
    write_binary(df, str(tmp_path / "out"))
    assert (tmp_path / "out" / "f").read_bytes() == b"yxxxx"


def test_hot_file_and_many_segments(spark, tmp_path):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("f"), F.col("id").cast("string"))).otherwise("hot").alias("name"),
        F.col("id").alias("chunk_no"),
        F.format_string("%05d;", "id").cast("binary").alias("binary_data"),
    )
    write_binary(df, str(tmp_path / "out"))
    want = "".join(f"{i:05d};" for i in range(5000) if i % 3)
    assert (tmp_path / "out" / "hot").read_text() == want


def test_order_numbers_may_be_sparse_or_equal(spark, tmp_path):
    df = spark.range(2000).select(
        F.lit("f").alias("name"),
        (F.col("id") * 1_000_003).alias("sparse"),
        F.lit(1).alias("equal"),
        F.format_string("%05d;", "id").cast("binary").alias("binary_data"),
    )
    write_binary(df.orderBy(F.rand(1)), str(tmp_path / "s"), order="sparse")
    assert (tmp_path / "s" / "f").read_text() == "".join(f"{i:05d};" for i in range(2000))
    write_binary(df, str(tmp_path / "e"), order="equal")
    text = (tmp_path / "e" / "f").read_text()
    assert sorted(text.split(";")[:-1]) == [f"{i:05d}" for i in range(2000)]


@pytest.mark.parametrize("name", ["../escape/x", "a/../../x", "/abs", "..", "", None])
@pytest.mark.parametrize("layout", ["offset", "stream"])
def test_names_stay_inside_the_target(spark, tmp_path, name, layout):
    df = spark.createDataFrame([("ok..fine/a..b", 0, b"1"), (name, 0, b"2")], "name string, chunk_no int, binary_data binary")
    with pytest.raises(Exception, match="leaves the target"):
        write_binary(df, str(tmp_path / "deep" / "out"), layout=layout)
    assert not (tmp_path / "deep" / "out").exists() and not (tmp_path / "deep" / "escape").exists()


def test_bytes_on_disk_are_compared_with_bytes_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "_done", lambda pa, names, sizes: binary_done(pa, names, [s + 1 for s in sizes]))
    df = spark.createDataFrame([("f", 0, b"x")], "name string, chunk_no int, binary_data binary")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old").write_bytes(b"old")
    with pytest.raises(OSError, match="holds 1 of 2 bytes"):
        write_binary(df, str(tmp_path / "out"))
    assert os.listdir(tmp_path) == ["out"] and os.listdir(tmp_path / "out") == ["old"]


def test_swap_puts_the_old_one_back(spark, tmp_path, monkeypatch):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "f").write_bytes(b"1")
    with pytest.raises(Exception):
        filesystem.swap(spark, str(tmp_path / "absent"), str(tmp_path / "old"))
    assert os.listdir(tmp_path) == ["old"] and (tmp_path / "old" / "f").read_bytes() == b"1"


def test_long_offset_lists_are_shuffled(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "BROADCAST_OFFSETS", 1)
    rows = named(read_binary(spark, folder, 1_000_000), folder)
    write_binary(rows, str(tmp_path / "out"))
    assert (tmp_path / "out" / "big %20.bin").read_bytes() == BIG


@pytest.mark.parametrize("layout", ["offset", "stream"])
def test_given_offsets(spark, folder, tmp_path, layout):
    rows = named(read_binary(spark, folder, 1_000_000), folder).withColumn("at", F.col("chunk_no") * 1_000_000)
    write_binary(rows.repartition(5), str(tmp_path / "out"), layout=layout, offset="at")
    assert (tmp_path / "out" / "big %20.bin").read_bytes() == BIG


@pytest.mark.parametrize("layout", ["offset", "stream"])
def test_merge_goes_by_task_number(spark, tmp_path, layout):
    parts = tmp_path / "parts"
    parts.mkdir()
    for task in (2, 99_999, 100_000):
        (parts / f"part-{task:05d}-u-c000.csv").write_bytes(f"{task};".encode())
    (parts / "part-00003-u-c000.csv").write_bytes(b"")
    merge_files(spark, str(parts), str(tmp_path / "out"), "one", b"head;", layout=layout)
    assert (tmp_path / "out" / "one").read_bytes() == b"head;2;99999;100000;"


def test_failed_write_leaves_the_old_files(spark, tmp_path):
    target = tmp_path / "out"
    target.mkdir()
    (target / "old").write_bytes(b"old")
    df = spark.range(3).select(
        F.lit("f").alias("name"), F.col("id").alias("chunk_no"), F.raise_error(F.lit("no")).cast("binary").alias("binary_data")
    )
    for layout in ("offset", "stream"):
        with pytest.raises(Exception):
            write_binary(df, str(target), layout=layout)
    assert os.listdir(tmp_path) == ["out"] and os.listdir(target) == ["old"]


def test_refusals(spark, tmp_path):
    with pytest.raises(MissingFieldError):
        write_binary(spark.range(1), str(tmp_path / "x"))
    df = spark.createDataFrame([("f", 0, b"a")], "name string, chunk_no int, binary_data binary")
    with pytest.raises(InvalidParameterError):
        write_binary(df, str(tmp_path / "x"), layout="magic")
    with pytest.raises(InvalidParameterError):
        read_binary(spark, str(tmp_path), chunk_bytes=0)


def test_object_store_settings(spark):
    conf = {
        "fs.s3a.bucket.b.endpoint": "host:9000",
        "fs.s3a.endpoint": "other",
        "fs.s3a.access.key": "k",
        "fs.s3a.bucket.b.connection.ssl.enabled": "false",
    }
    assert s3_options(conf.get, "b") == {"access_key": "k", "endpoint_override": "host:9000", "scheme": "http"}
    assert s3_options(conf.get, "c") == {"access_key": "k", "endpoint_override": "other", "scheme": "https"}
    assert arrow_options(spark, "obs://b/f") is None
    assert arrow_options(spark, "hdfs://n/f") == {} and arrow_options(spark, "/a/b") == {}


def test_path_forms():
    for uri in ("/a/b c%20", "file:/a/b c%20", "file:///a/b c%20"):
        assert open_filesystem(uri)[1] == "/a/b c%20"


def test_many_small_files_make_few_tasks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3000):
        (folder / f"{i} +é%.bin").write_bytes(b"" if i % 3 == 0 else b"x" * (i % 7 + 1))
    rows = read_binary(spark, str(folder))
    # Thirty-two files a task would be 63, and as many again for the files without a byte.
    assert rows.rdd.getNumPartitions() <= 4 * max(8, spark.sparkContext.defaultParallelism)
    assert rows.count() == 3000 and rows.where("octet_length(binary_data) = 0").count() == 1000
    listed = spark.read.format("binaryFile").load(str(folder))
    assert sorted(filesystem.input_files(listed)) == sorted(listed.inputFiles())
    assert filesystem.input_files(spark.range(3)) == []
