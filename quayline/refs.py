"""What to read or write: data sources, datasets and their formats."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from quayline.errors import InvalidParameterError, MissingParameterError
from quayline.functions.literal import quote_ident
from quayline.types import Column, as_columns, declared_schema


class StorageKind(str, Enum):
    """The storage system behind a data source."""

    LOCAL = "localfs"
    MINIO = "minio"
    OSS = "oss"
    OBS = "obs"
    MYSQL = "mysql"
    WAREHOUSE = "warehouse"


class FileFormat(str, Enum):
    """How a dataset is stored."""

    CSV = "csv"
    BINARY = "binary"
    ORC = "orc"
    PARQUET = "parquet"
    TABLE = "table"


class ContentType(str, Enum):
    """The form a dataset is handed over in."""

    TABLE = "table"
    RAW = "raw"
    CSV = "csv"


# Source type names accepted in a descriptor.
_KIND_NAMES = {
    "localfs": StorageKind.LOCAL,
    "minio": StorageKind.MINIO,
    "oss": StorageKind.OSS,
    "obs": StorageKind.OBS,
    "mysql": StorageKind.MYSQL,
    "odps": StorageKind.WAREHOUSE,
    "warehouse": StorageKind.WAREHOUSE,
}

# Dataset types, and the URI scheme of each object store.
DATASET_TYPES = ("table", "model", "rule", "report", "serving_model", "unknown")
UPLOAD_TYPES = ("table", "model", "rule", "serving_model")
_SCHEMES = {StorageKind.MINIO: "s3a", StorageKind.OSS: "oss", StorageKind.OBS: "obs"}

_OBJECT_STORES = tuple(_SCHEMES)
FILE_KINDS = (StorageKind.LOCAL, *_OBJECT_STORES)


def join_path(*parts: str | None) -> str:
    """Join path parts with single slashes, skipping the missing ones."""
    trimmed = [p.strip("/") for p in parts if p is not None]
    return "/".join(p for p in trimmed if p)


@dataclass(frozen=True)
class CsvFormat:
    """CSV dialect. Only the first character of each mark is used.

    A declared ``encoding`` saves readers the pass that detects it.
    """

    separator: str = ","
    quote: str = '"'
    escape: str = "\\"
    header: bool = True
    field_map: dict[str, str] = field(default_factory=dict)
    encoding: str | None = None

    def dialect(self) -> dict[str, str]:
        marks = {"sep": self.separator, "quote": self.quote, "escape": self.escape}
        for name, mark in marks.items():
            if not mark:
                raise InvalidParameterError(f"CSV {name} is empty")
        return {name: mark[0] for name, mark in marks.items()}


@dataclass(frozen=True)
class TableIndex:
    """A secondary index of a database table."""

    columns: tuple[str, ...]
    unique: bool = False


@dataclass(frozen=True)
class PageRule:
    """How a database table is cut into key-range pages; gaps are measured."""

    key: str
    lower: object = None
    upper: object = None
    step: object = None
    predicates: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableFormat:
    """Options of a database table."""

    primary_key: str | None = None
    indexes: tuple[TableIndex, ...] = ()
    pages: PageRule | None = None
    field_map: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SourceRef:
    """A named storage system and how to reach it."""

    kind: str
    id: str = ""
    path: str | None = None
    storage_type: str | None = None
    endpoint: str | None = None
    bucket: str | None = None
    prefix: str | None = None
    access_key: str | None = None
    access_secret: str | None = field(default=None, repr=False)
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    database: str | None = None

    @property
    def storage(self) -> StorageKind:
        if self.kind not in _KIND_NAMES:
            raise InvalidParameterError(f"unsupported data source type {self.kind!r}")
        kind = _KIND_NAMES[self.kind]
        if kind is StorageKind.OSS and self.storage_type == "minio":
            return StorageKind.MINIO
        return kind

    def uri(self, relative: str | None = None) -> str:
        """The full URI of a path below this source."""
        kind = self.storage
        if kind is StorageKind.LOCAL:
            if self.path and ":/" in self.path:
                # Already a URI, a mounted or Hadoop folder all executors share.
                return self.path.rstrip("/") + ("/" + join_path(relative) if relative else "")
            return "file:///" + join_path(self.path, relative)
        if kind in _OBJECT_STORES:
            if not self.bucket:
                raise MissingParameterError(f"data source {self.id or self.kind} has no bucket")
            return f"{_SCHEMES[kind]}://" + join_path(self.bucket, self.prefix, relative)
        if kind is StorageKind.MYSQL:
            return self.jdbc_url()
        return join_path(self.path, relative) if self.path is None else "/" + join_path(self.path, relative)

    def jdbc_url(self) -> str:
        if not self.endpoint:
            raise MissingParameterError(f"data source {self.id or self.kind} has no endpoint")
        url = "jdbc:mysql://" + self.endpoint
        return f"{url}/{self.database}" if self.database else url

    def hadoop_options(self) -> dict[str, str]:
        """Hadoop settings of the object store connector, empty for other kinds."""
        kind = self.storage
        if kind not in _OBJECT_STORES:
            return {}
        for name in ("endpoint", "access_key", "access_secret"):
            if not getattr(self, name):
                raise MissingParameterError(f"data source {self.id or self.kind} has no {name}")
        if kind is StorageKind.MINIO:
            # Per bucket, so that sources with other keys can share the session.
            base = f"fs.s3a.bucket.{self.bucket}."
            return {
                base + "endpoint": self.endpoint,
                base + "access.key": self.access_key,
                base + "secret.key": self.access_secret,
                base + "path.style.access": "true",
                base + "connection.ssl.enabled": "false",
                base + "attempts.maximum": "1",
            }
        if kind is StorageKind.OSS:
            return {
                "fs.oss.impl": "org.apache.hadoop.fs.aliyun.oss.AliyunOSSFileSystem",
                "fs.oss.endpoint": self.endpoint,
                "fs.oss.accessKeyId": self.access_key,
                "fs.oss.accessKeySecret": self.access_secret,
            }
        return {
            "fs.obs.impl": "org.apache.hadoop.fs.obs.OBSFileSystem",
            "fs.obs.endpoint": self.endpoint,
            "fs.obs.access.key": self.access_key,
            "fs.obs.secret.key": self.access_secret,
        }

    def apply(self, spark: SparkSession) -> None:
        """Give the session's Hadoop configuration this source's settings."""
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for key, value in self.hadoop_options().items():
            conf.set(key, value)


@dataclass(frozen=True)
class DatasetRef:
    """A dataset inside a source."""

    source: SourceRef
    relative_uri: str
    type: str = "table"
    file_format: str = "csv"
    columns: tuple[Column, ...] = ()
    partition_columns: tuple[str, ...] = ()
    id: str = ""
    name: str = ""
    vendor: str = ""
    csv: CsvFormat = field(default_factory=CsvFormat)
    table: TableFormat = field(default_factory=TableFormat)

    @staticmethod
    def of(source: SourceRef, relative_uri: str, columns=None, **rest) -> "DatasetRef":
        """Build a reference from any accepted column declaration."""
        return DatasetRef(source, relative_uri, columns=tuple(as_columns(columns)), **rest)

    @property
    def structured(self) -> bool:
        """Only datasets of type ``table`` carry columns; the rest are bytes."""
        return self.type == "table"

    @property
    def schema(self) -> T.StructType | None:
        return declared_schema(self.columns) if self.columns and self.structured else None


@dataclass(frozen=True)
class ReaderSpec:
    """A dataset reference resolved to one reader: what it is and where it lies."""

    reader: str
    location: str
    schema: T.StructType | None


def resolve(ref: DatasetRef, content_type: str = "table") -> ReaderSpec:
    """Pick the reader for (source kind, file format, dataset type, content type)."""
    kind = ref.source.storage
    fmt, content = FileFormat(ref.file_format), ContentType(content_type)
    if ref.type not in DATASET_TYPES:
        raise InvalidParameterError(f"unknown dataset type {ref.type!r}")
    if not ref.relative_uri:
        raise MissingParameterError("a dataset needs its relative URI or table name")
    if kind is StorageKind.MYSQL:
        return ReaderSpec("jdbc", quote_ident(ref.relative_uri), ref.schema)
    if kind is StorageKind.WAREHOUSE:
        if fmt is FileFormat.BINARY:
            return ReaderSpec("resource", ref.source.uri(ref.relative_uri), None)
        return ReaderSpec("warehouse", ref.relative_uri, ref.schema)
    location = ref.source.uri(ref.relative_uri)
    if fmt is FileFormat.TABLE:
        raise InvalidParameterError("a file source holds csv, binary, orc or parquet datasets")
    # Raw content is the file as it lies there, whatever its format.
    as_bytes = content is ContentType.RAW or (fmt is FileFormat.CSV and content is ContentType.CSV)
    if fmt is FileFormat.BINARY or as_bytes:
        return ReaderSpec("binary", location, None)
    return ReaderSpec(fmt.value, location, ref.schema)
