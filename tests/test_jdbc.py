"""The database side is tested up to the text and options Spark is given: no database runs here."""

import datetime as dt
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import quayline.sources.jdbc as jdbc
from quayline.errors import InvalidParameterError, MissingFieldError, MissingParameterError, UnsupportedTypeError
from quayline.operators.paging import KeyStats, plan_pages
from quayline.refs import PageRule, SourceRef, TableFormat, TableIndex
from quayline.sinks.jdbc import jdbc_projection, mysql_ddl, run_statements, synthetic_key, write_jdbc

SOURCE = SourceRef("mysql", endpoint="host:3306", user="u", password="p", database="d")


@pytest.fixture
def table(spark, monkeypatch):
    """Stand in for the database: a scan gives the table, a query its aggregates."""
    df = spark.range(1000).select(
        (F.col("id") + 5).alias("id"),
        F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 4).alias("k"),
        F.lit("some text").alias("t"),
        F.lit(dt.datetime(2024, 1, 1, 0, 0, 0, 123456)).alias("at"),
    )
    seen = {"scans": [], "queries": [], "indexes": []}

    def load(_, scan):
        seen["scans"].append(scan)
        if not scan.predicates:
            return df
        out = df.where(F.expr(scan.predicates[0]))
        for p in scan.predicates[1:]:
            out = out.unionByName(df.where(F.expr(p)))
        return out

    def query(session, options, sql):
        seen["queries"].append(sql)
        if "information_schema" in sql:
            return session.createDataFrame(seen["indexes"], "index_name string, non_unique int, seq int, column_name string")
        df.createOrReplaceTempView("t")
        return session.sql(sql)

    monkeypatch.setattr(jdbc, "load", load)
    monkeypatch.setattr(jdbc, "query", query)
    seen["df"] = df
    return seen


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_connection_options():
    options = jdbc.connection_options(SOURCE)
    assert options == {
        "url": "jdbc:mysql://host:3306/d",
        "driver": "com.mysql.cj.jdbc.Driver",
        "useCursorFetch": "true",
        "fetchsize": "10000",
        "user": "u",
        "password": "p",
    }


def test_plain_scan(spark, table):
    found = jdbc.read_jdbc(spark, SOURCE, "t", ["t", "id"], where="id < 10")
    assert found.columns == ["t", "id"] and found.count() == 5
    assert table["scans"][0].table == "`t`" and table["scans"][0].predicates == []


def test_paged_scan_returns_every_row(spark, table):
    found = jdbc.read_jdbc(spark, SOURCE, "t", ["id", "k"], pages=PageRule("id", step=64))
    assert len(table["scans"][-1].predicates) == 16
    assert same(found, table["df"].select("id", "k"))


def test_null_keys_and_hot_keys(spark, table):
    rule = PageRule("k", step=1)
    found = jdbc.read_jdbc(spark, SOURCE, "t", ["id", "k"], pages=rule, split_by="id", max_page_rows=60)
    predicates = table["scans"][-1].predicates
    assert "CRC32" in predicates[0] and any("IS NULL AND" in p for p in predicates)
    assert len(predicates) > 15
    assert same(found, table["df"].select("id", "k"))
    with pytest.raises(MissingParameterError):
        jdbc.read_jdbc(spark, SOURCE, "t", pages=rule, max_page_rows=60)


def test_primary_key_pages_only_if_numeric(spark, table):
    jdbc.read_jdbc(spark, SOURCE, "t", primary_key="id", page_bytes=10_000)
    assert len(table["scans"][-1].predicates) > 1
    jdbc.read_jdbc(spark, SOURCE, "t", primary_key="t")
    assert table["scans"][-1].predicates == []
    with pytest.raises(InvalidParameterError):
        jdbc.read_jdbc(spark, SOURCE, "t", pages=PageRule("t"))


def test_primary_key_is_looked_up(spark, table):
    table["indexes"] = [("PRIMARY", 0, 1, "id"), ("by_k", 1, 1, "k")]
    found = jdbc.read_jdbc(spark, SOURCE, "t", ["id"], page_bytes=10_000)
    assert len(table["scans"][-1].predicates) > 1 and same(found, table["df"].select("id"))
    assert "information_schema" in table["queries"][0] and "TABLE_SCHEMA = 'd'" in table["queries"][0]
    assert table["queries"][-1] == "SELECT * FROM `t` LIMIT 100"
    jdbc.read_jdbc(spark, SOURCE, "t", pages=PageRule("id", step=100))
    assert sum("information_schema" in q for q in table["queries"]) == 1


def test_declared_primary_key_has_to_exist(spark, table):
    with pytest.raises(InvalidParameterError, match="primary key 'nope' does not exist"):
        jdbc.read_jdbc(spark, SOURCE, "t", primary_key="nope")


def test_given_predicates_win(spark, table):
    rule = PageRule("id", predicates=("id < 100", "id >= 100"))
    assert jdbc.read_jdbc(spark, SOURCE, "t", pages=rule).count() == 1000
    assert table["scans"][-1].predicates == ["id < 100", "id >= 100"] and table["queries"] == []


def test_names_are_mapped_after_the_scan(spark, table):
    found = jdbc.read_jdbc(
        spark, SOURCE, "t", ["key"], where="key > 1000", pages=PageRule("key", step=100), field_map={"id": "key"}
    )
    assert table["scans"][-1].predicates[0].startswith("`id` <")
    assert sorted(r.key for r in found.collect()) == [1001, 1002, 1003, 1004]


def test_values_end_at_the_millisecond(spark, table):
    assert jdbc.read_jdbc(spark, SOURCE, "t", ["at"]).first().at.microsecond == 123000


def test_decimals_round_up(spark):
    df = spark.sql("SELECT CAST(1.2341 AS DECIMAL(9, 4)) AS a, CAST(-1.2341 AS DECIMAL(9, 4)) AS b")
    found = jdbc.as_read(df, {"a": (7, 2), "b": (7, 2)}).first()
    assert (str(found.a), str(found.b)) == ("1.24", "-1.23")
    with pytest.raises(MissingFieldError):
        jdbc.as_read(df, {"c": (7, 2)})


def test_custom_schema_and_extra_options(spark, table):
    jdbc.read_jdbc(spark, SOURCE, "t", custom_schema="k DECIMAL(12,2)", extra_options={"fetchsize": "1000"})
    options = table["scans"][-1].options
    assert options["customSchema"] == "k DECIMAL(12,2)" and options["fetchsize"] == "1000"


def test_split_count_and_connection_limit(spark, table):
    found = jdbc.read_jdbc(spark, SOURCE, "t", ["id"], primary_key="id", splits=20, max_connections=3)
    assert 20 <= len(table["scans"][-1].predicates) <= 21
    assert found.rdd.getNumPartitions() == 3
    assert same(found, table["df"].select("id"))


def test_type_overrides():
    schema = T.StructType.fromDDL("a int, b string, c array<string>")
    text = jdbc.type_overrides(schema, {"a": "DECIMAL(12,2)"}, {3: T.ArrayType(T.LongType())})
    assert text == "`a` DECIMAL(12,2), `c` array<bigint>"
    for bad in ({"by_name": {"x": "int"}}, {"by_index": {0: "int"}}):
        with pytest.raises(MissingFieldError):
            jdbc.type_overrides(schema, **bad)


def test_statistics_statement():
    assert jdbc.stats_sql("`t`", "k") == (
        "SELECT MIN(`k`) AS min_key, MAX(`k`) AS max_key, COUNT(*) AS row_count, "
        "COUNT(*) - COUNT(`k`) AS null_keys FROM `t`"
    )


def test_histogram_statement():
    pages = plan_pages(KeyStats(10, 99, 90, 0, 8.0), step=20)
    assert "FLOOR((`k` - (10)) / 20)" in jdbc.histogram_sql("`t`", "k", pages)
    dates = plan_pages(KeyStats(dt.date(2024, 1, 1), dt.date(2024, 3, 1), 90, 0, 8.0), step=10)
    assert "FLOOR(DATEDIFF(`d`, '2024-01-01') / 10)" in jdbc.histogram_sql("`t`", "d", dates)
    assert jdbc.rows_per_page([(-1, 2), (0, 3), (99, 4)], pages, 0) == [5, 0, 0, 0, 4]


def test_index_profile(spark):
    stats = spark.createDataFrame(
        [("PRIMARY", 0, 2, "b"), ("PRIMARY", 0, 1, "a"), ("by_c", 1, 1, "c")],
        "index_name string, non_unique int, seq int, column_name string",
    )
    profile = jdbc.index_profile(stats)
    found = {r.index_name: (r.is_unique, r.columns) for r in profile.collect()}
    assert found == {"PRIMARY": (True, ["a", "b"]), "by_c": (False, ["c"])}
    assert jdbc.primary_key_of(profile) == "a"
    assert jdbc.primary_key_of(profile.where("index_name = 'by_c'")) is None
    assert "TABLE_NAME = 'o''k' AND TABLE_SCHEMA = 'd'" in jdbc.index_sql("d", "o'k")


def test_origin_metadata():
    schema = jdbc.with_origin(T.StructType.fromDDL("a int"), "d", "t")
    assert schema["a"].metadata["SQL_TABLE_NAME"] == "t"


def test_ddl():
    schema = T.StructType.fromDDL("id bigint, name string, price decimal(12,2), at timestamp")
    fmt = TableFormat(
        primary_key="id", indexes=(TableIndex(("name", "price"), unique=True), TableIndex(()), TableIndex(("at",)))
    )
    drop, create = mysql_ddl("t`x", schema, fmt, allow_drop=True)
    assert drop == "DROP TABLE IF EXISTS `t``x`"
    assert create == (
        "CREATE TABLE `t``x` (`name` TEXT, `price` DECIMAL(12,2), "
        "`at` TIMESTAMP DEFAULT '2000-01-01 00:00:00', "
        "`id` BIGINT PRIMARY KEY NOT NULL AUTO_INCREMENT, "
        "UNIQUE KEY `idx_0` (`name`(128), `price`), INDEX `idx_2` (`at`)) "
        "ENGINE=InnoDB DEFAULT CHARSET=utf8mb4"
    )
    assert len(mysql_ddl("t", schema, fmt)) == 1
    with pytest.raises(MissingFieldError):
        mysql_ddl("t", schema, TableFormat(indexes=(TableIndex(("zz",)),)))


def test_statements_run_on_one_connection():
    jvm = MagicMock()
    driver = jvm.java.lang.Class.forName.return_value.newInstance.return_value
    connection = driver.connect.return_value
    connection.createStatement.return_value.execute.side_effect = [True, RuntimeError("refused")]
    with pytest.raises(RuntimeError):
        run_statements(SimpleNamespace(_jvm=jvm), SOURCE, ["DROP", "CREATE", "never"])
    assert driver.connect.call_args.args[0] == "jdbc:mysql://host:3306/d"
    assert [c.args for c in jvm.java.util.Properties.return_value.setProperty.call_args_list] == [
        ("user", "u"),
        ("password", "p"),
    ]
    executed = [c.args[0] for c in connection.createStatement.return_value.execute.call_args_list]
    assert executed == ["DROP", "CREATE"]
    connection.close.assert_called_once_with()


def test_synthetic_key():
    assert synthetic_key().startswith("pk_") and len(synthetic_key()) == 9
    assert "`pk_" in mysql_ddl("t", T.StructType.fromDDL("a int"))[0]


def test_unsupported_columns_stop_before_any_write(spark):
    with pytest.raises(UnsupportedTypeError):
        jdbc_projection(spark.sql("SELECT named_struct('a', 1) AS s"))
    with pytest.raises(InvalidParameterError):
        write_jdbc(spark.range(1), SOURCE, "t", mode="ignore")
