"""Even splits of file datasets and slices filled by running bytes."""

import os

import pytest
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError
from quayline.operators.running import running_total
from quayline.plans import copy_dataset, read_dataset, read_splits, write_dataset
from quayline.plans.splits import even_pieces
from quayline.refs import CsvFormat, DatasetRef, SourceRef
from quayline.sinks.slices import SLICE, slice_number
from tests.test_csv import put


@pytest.fixture
def source(tmp_path):
    return SourceRef("localfs", path=str(tmp_path))


def test_pieces_are_even_whatever_the_files(spark):
    for lengths, several in (([1000], (1, 7)), ([10] * 40, (3, 80)), ([3, 500, 2, 499, 1], (7, 10)), ([1, 2], (4,))):
        files = spark.createDataFrame([(f"f{i:03}", n) for i, n in enumerate(lengths)], "path string, length bigint")
        for n in several:
            pieces = even_pieces(files, n).collect()
            sizes = [sum(p.stop - p.start for p in pieces if p.split == s) for s in range(n)]
            assert max(sizes) - min(sizes) <= 1 and sum(sizes) == sum(lengths)
            for i, length in enumerate(lengths):
                own = sorted((p.start, p.stop) for p in pieces if p.path == f"f{i:03}")
                assert own[0][0] == 0 and own[-1][1] == length and all(a[1] == b[0] for a, b in zip(own, own[1:]))
            whole = even_pieces(files, n, 16).collect()
            assert all(p.start % 16 == 0 for p in whole) and sum(p.stop - p.start for p in whole) == sum(lengths)
    huge = spark.createDataFrame([("a", 10**17), ("b", 10**17 + 3)], "path string, length bigint")
    sizes = even_pieces(huge, 9).groupBy("split").agg(F.sum(F.col("stop") - F.col("start")).alias("n")).collect()
    assert len(sizes) == 9 and max(r.n for r in sizes) - min(r.n for r in sizes) <= 1
    assert even_pieces(huge.where("false"), 4).count() == 0


def test_running_total_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr("quayline.operators.running.ROWS", 30)
    df = spark.range(200).select("id", (F.col("id") % 7).alias("w"), F.lit(1).alias("__x")).repartition(5)
    assert {(r.id, r.before) for r in running_total(df, ["id"], "w").collect()} == {(i, sum(j % 7 for j in range(i))) for i in range(200)}


def per_partition(df):
    return [r[1] for r in sorted(df.groupBy(F.spark_partition_id().alias("p")).count().collect())]


def test_splits_hold_every_row_once(spark, source, tmp_path):
    df = spark.range(3000).select("id", F.concat(F.lit("x\n"), F.repeat(F.lit("y"), (F.col("id") % 50).cast("int"))).alias("t"))
    ref = DatasetRef.of(source, "d", df.schema)
    write_dataset(df.repartition(3), ref)
    for n in (1, 4, 11):
        split = read_splits(spark, ref, n, multiline=True)
        assert split.rdd.getNumPartitions() == n and split.exceptAll(df).count() == 0 and split.count() == 3000
        sizes = per_partition(split)
        assert len(sizes) == n and max(sizes) < 1.3 * min(sizes)
    one = read_splits(spark, ref, 4, ["t"], multiline=True, range_bytes=512)
    assert one.columns == ["t"] and one.rdd.getNumPartitions() == 4 and one.count() == 3000
    # More splits than rows: some are empty, none is lost.
    put(tmp_path / "d", "z.csv", "id,t\n9999,a\n")
    many = read_splits(spark, ref, 60, multiline=True)
    assert many.rdd.getNumPartitions() == 60 and many.count() == 3001


def test_splits_of_plain_lines_and_charsets(spark, source):
    df = spark.range(900).select("id", F.concat(F.lit('汉"\\,'), F.col("id")).alias("t"))
    for encoding in (None, "GB18030", "UTF-16LE", "UTF-32"):
        ref = DatasetRef.of(source, f"e{encoding}", df.schema, csv=CsvFormat(encoding=encoding))
        write_dataset(df.repartition(2), ref)
        split = read_splits(spark, ref, 5)
        assert split.rdd.getNumPartitions() == 5 and split.count() == 900 and split.exceptAll(df).count() == 0


def test_splits_of_bytes_and_columnar_files(spark, source, tmp_path):
    os.mkdir(tmp_path / "raw")
    for name, n in (("a", 10_000), ("b", 1), ("c", 0), ("d", 3333)):
        put(tmp_path / "raw", name, bytes(i % 251 for i in range(n)))
    raw = DatasetRef(source, "raw", "model", "binary")
    split = read_splits(spark, raw, 3, content_type="raw", chunk_bytes=100)
    want = read_dataset(spark, raw, content_type="raw", chunk_bytes=100).where("octet_length(binary_data) > 0")
    assert split.rdd.getNumPartitions() == 3 and split.exceptAll(want).count() == 0 and split.count() == want.count()
    sizes = per_partition(split)
    assert max(sizes) - min(sizes) <= 2
    df = spark.range(500).select("id", F.lit("x").alias("t"))
    orc = DatasetRef.of(source, "o", df.schema, file_format="orc")
    write_dataset(df, orc)
    split = read_splits(spark, orc, 6)
    assert split.rdd.getNumPartitions() == 6 and split.exceptAll(df).count() == 0
    for n in (0, -1):
        with pytest.raises(InvalidParameterError):
            read_splits(spark, orc, n)
    with pytest.raises(InvalidParameterError):
        read_splits(spark, DatasetRef.of(SourceRef("odps"), "t", df.schema, file_format="table"), 2)


def test_compressed_files_have_no_splits(spark, source):
    df = spark.range(10).select("id")
    df.write.option("header", True).option("compression", "gzip").csv(source.path + "/z")
    with pytest.raises(Exception, match="compressed"):
        read_splits(spark, DatasetRef.of(source, "z", df.schema, csv=CsvFormat(encoding="UTF-8")), 2).collect()


def test_slice_numbers_are_greedy(spark):
    widths = [5, 5, 1, 10, 11, 3, 1, 1, 1, 1, 25, 4, 6, 1] * 400
    df = spark.createDataFrame([(i, w) for i, w in enumerate(widths)], "i int, w int").coalesce(1).orderBy("i")
    want, number, held = [], 0, 0
    for w in widths:
        if held and held + w > 10:
            number, held = number + 1, 0
        want.append(number)
        held += w
    got = df.withColumn(SLICE, slice_number(F.col("w"), 10)).orderBy("i").collect()
    assert [r[SLICE] for r in got] == want
    with pytest.raises(InvalidParameterError):
        slice_number(F.col("w"), 0)


def test_one_wide_row_costs_one_file(spark, source, tmp_path):
    narrow = spark.range(2000).select("id", F.lit("n" * 20).alias("t"))
    df = narrow.where("id < 700").union(spark.range(1).select((F.col("id") - 1).alias("id"), F.repeat(F.lit("w"), 30_000).alias("t")))
    df = df.union(narrow.where("id >= 700")).coalesce(1)
    a = DatasetRef.of(source, "a", df.schema, file_format="parquet")
    write_dataset(df, a)
    for encoding in ("UTF-8", "GB18030", "UTF-16LE"):
        to = DatasetRef.of(source, f"s{encoding}", df.schema, csv=CsvFormat(encoding=encoding))
        copy_dataset(spark, a, to, slice_bytes=4000)
        folder = tmp_path / f"s{encoding}"
        sizes = [os.path.getsize(folder / f) for f in sorted(os.listdir(folder)) if f.startswith("part")]
        wide = [s for s in sizes if s > 4000]
        # All but the last file and the one before the wide row are filled.
        assert len(wide) == 1 and sum(s < 3900 for s in sizes if s <= 4000) <= 2
        assert read_dataset(spark, to).exceptAll(df).count() == 0
    empty = DatasetRef.of(source, "empty", df.schema)
    write_dataset(df.where("false"), empty, slice_bytes=100)
    assert read_dataset(spark, empty).count() == 0
    for bad in ({"mode": "append"}, {"max_records_per_file": 5}):
        with pytest.raises(InvalidParameterError):
            write_dataset(df, to, slice_bytes=100, **bad)
    with pytest.raises(InvalidParameterError):
        write_dataset(df, DatasetRef(source, "raw", "model", "binary"), "raw", slice_bytes=5)


def test_files_that_are_split_grow_in_number(spark, tmp_path, monkeypatch):
    from quayline.workloads import QUERIES, datasets

    rows = [(i, None if i % 50 == 0 else "" if i % 50 == 1 else f"text {i}\n\"{i}\"" * 9, "en", "s", 5) for i in range(400)] + [(None, "no id", None, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    parts, write = [], datasets.write_dataset

    def seen(df, *args, **kwargs):
        parts.append(df.rdd.getNumPartitions())
        return write(df, *args, **kwargs)

    monkeypatch.setattr(datasets, "write_dataset", seen)
    for size in (datasets._SPLIT_FILE, 4096):
        monkeypatch.setattr(datasets, "_SPLIT_FILE", size, raising=False)
        assert [tuple(r) for r in QUERIES["even_splits_documents"](spark, str(tmp_path)).collect()] == [(401, 7, True)]
    assert parts[0] == 3 and parts[1] > 10
