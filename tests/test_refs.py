import pytest

from quayline.errors import InvalidParameterError, MissingParameterError
from quayline.refs import CsvFormat, DatasetRef, SourceRef, StorageKind, join_path, resolve

LOCAL = SourceRef("localfs", path="/data/")
MINIO = SourceRef(
    "oss", storage_type="minio", endpoint="host:9000", bucket="b", prefix="/p/", access_key="k", access_secret="s"
)
MYSQL = SourceRef("mysql", endpoint="host:3306", user="u", password="p", database="d")


def test_join_path_trims_and_skips():
    assert join_path("/a/", None, "b/", "", "/c") == "a/b/c"


def test_uris():
    assert LOCAL.uri("/x/y/") == "file:///data/x/y"
    assert MINIO.storage is StorageKind.MINIO
    assert MINIO.uri("f.csv") == "s3a://b/p/f.csv"
    assert SourceRef("oss", bucket="b").uri("f") == "oss://b/f"
    assert SourceRef("obs", bucket="b").uri("f") == "obs://b/f"
    assert SourceRef("localfs", path="hdfs://n/d/").uri("/f") == "hdfs://n/d/f"
    assert MYSQL.uri() == "jdbc:mysql://host:3306/d"


def test_unknown_source_and_missing_fields():
    with pytest.raises(InvalidParameterError):
        SourceRef("ftp").storage
    with pytest.raises(MissingParameterError):
        SourceRef("oss").uri("f")
    with pytest.raises(MissingParameterError):
        SourceRef("mysql").jdbc_url()
    with pytest.raises(MissingParameterError):
        SourceRef("oss", bucket="b").hadoop_options()


def test_object_store_options():
    options = MINIO.hadoop_options()
    assert options["fs.s3a.bucket.b.endpoint"] == "host:9000"
    assert options["fs.s3a.bucket.b.connection.ssl.enabled"] == "false"
    assert options["fs.s3a.bucket.b.attempts.maximum"] == "1"
    oss = SourceRef("oss", bucket="b", endpoint="e", access_key="k", access_secret="s").hadoop_options()
    assert oss["fs.oss.accessKeyId"] == "k"
    obs = SourceRef("obs", bucket="b", endpoint="e", access_key="k", access_secret="s").hadoop_options()
    assert obs["fs.obs.secret.key"] == "s"
    assert LOCAL.hadoop_options() == {}


def test_secrets_are_not_shown():
    assert "s3cret" not in repr(SourceRef("mysql", password="s3cret", access_secret="s3cret"))


def test_options_reach_the_session(spark):
    MINIO.apply(spark)
    assert spark.sparkContext._jsc.hadoopConfiguration().get("fs.s3a.bucket.b.access.key") == "k"


@pytest.mark.parametrize(
    "source, fmt, kind, content, reader",
    [
        (LOCAL, "csv", "table", "table", "csv"),
        (LOCAL, "csv", "table", "raw", "binary"),
        (LOCAL, "csv", "table", "csv", "binary"),
        (LOCAL, "binary", "model", "table", "binary"),
        (LOCAL, "orc", "table", "table", "orc"),
        (LOCAL, "orc", "table", "raw", "binary"),
        (MYSQL, "table", "table", "table", "jdbc"),
        (SourceRef("odps"), "csv", "table", "table", "warehouse"),
        (SourceRef("warehouse"), "binary", "model", "table", "resource"),
    ],
)
def test_resolve(source, fmt, kind, content, reader):
    assert resolve(DatasetRef(source, "t", kind, fmt), content).reader == reader


def test_resolve_refuses():
    with pytest.raises(InvalidParameterError):
        resolve(DatasetRef(LOCAL, "t", "picture"))
    with pytest.raises(MissingParameterError):
        resolve(DatasetRef(LOCAL, ""))
    with pytest.raises(InvalidParameterError):
        resolve(DatasetRef(LOCAL, "t", file_format="table"))


def test_only_tables_have_a_schema():
    columns = {"a": "int64"}
    assert DatasetRef.of(LOCAL, "t", columns).schema.names == ["a"]
    assert DatasetRef.of(LOCAL, "t", columns, type="model").schema is None


def test_dialect_uses_first_character():
    assert CsvFormat(separator=";;", quote="'x").dialect() == {"sep": ";", "quote": "'", "escape": "\\"}
    with pytest.raises(InvalidParameterError):
        CsvFormat(separator="").dialect()
