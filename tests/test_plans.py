"""Plans that must keep their shape to hold at scale."""

from pyspark.sql import functions as F

from quayline.operators.paging import key_stats_frame, page_histogram
from quayline.sinks.binary import _place
from quayline.sinks.warehouse import create_table, write_partitions
from quayline.sources.binary import read_binary
from quayline.sources.charset import non_utf8_files
from quayline.sources.csv import read_csv
from quayline.sources.warehouse import read_table

TABLES = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_scan_is_map_only_and_pruned(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b,c\n1,true,2\n")
    text = plan(read_csv(spark, str(tmp_path), {"c": "int64", "b": "bool"}).where("c > 1"))
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<b:string,c:bigint,__record:string>" in text
    assert "PushedFilters: [IsNotNull(c), GreaterThan(c,1)]" in text


def test_charset_scan_filters_before_it_hashes(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a\n1\n")
    text = plan(non_utf8_files(spark, str(tmp_path)))
    assert "SortAggregate" not in text and "Python" not in text
    # Read from the bottom: scan, filter on the raw line, then the partial aggregate.
    lines = text.splitlines()
    last = max(i for i, line in enumerate(lines) if "HashAggregate" in line)
    assert any("Filter" in line and "value" in line for line in lines[last + 1:])


def test_partition_spec_prunes(spark, tmp_path):
    events = spark.read.parquet(f"{TABLES}/events.parquet")
    create_table(spark, "plan_events", events.schema, "event_type=x", str(tmp_path / "w"))
    write_partitions(events, "plan_events")
    text = plan(read_table(spark, "plan_events", ["event_id"], partition_spec="event_type=click"))
    assert "PartitionFilters: [isnotnull(event_type" in text and "ReadSchema: struct<event_id:bigint>" in text


def test_statistics_read_one_column_once(spark):
    orders = spark.read.parquet(f"{TABLES}/orders.parquet").select("o_orderkey")
    text = plan(key_stats_frame(orders, "o_orderkey"))
    assert text.count("Scan parquet") == 1 and "partial_min" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_histogram_aggregates_before_it_shuffles(spark):
    orders = spark.read.parquet(f"{TABLES}/orders.parquet")
    text = plan(page_histogram(orders, "o_orderkey", 0, 100))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_bytes_are_not_sorted_for_their_place(spark, tmp_path):
    rows = spark.range(10).select(
        F.col("id").alias("row_id"),
        F.lit("f").alias("name"),
        F.col("id").alias("chunk_no"),
        F.lit(1).alias("size"),
        F.lit(b"x").alias("binary_data"),
    )
    rows.write.parquet(str(tmp_path / "r"))
    text = plan(_place(spark.read.parquet(str(tmp_path / "r"))))
    assert "ShuffledHashJoin" in text
    assert not any("Sort" in line and "binary_data" in line for line in text.splitlines())
    text = plan(_place(spark.read.parquet(str(tmp_path / "r")), small=True))
    assert "BroadcastHashJoin" in text
    assert not any("Exchange" in line and "binary_data" in line for line in text.splitlines())


def test_copy_of_bytes_needs_no_shuffle(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"x" * 100)
    text = plan(read_binary(spark, str(tmp_path), 10))
    assert "Exchange" not in text and "Python" not in text
