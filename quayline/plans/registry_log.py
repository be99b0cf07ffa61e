"""Sources and datasets registered in a shared folder, as a log of versions.

Every change of an entry is a new file, ``<kind>/<id>/<version>.json``, that is put in place only
if it is absent: of two writers of one version one is refused. Nothing is overwritten, so readers
see an entry before a change or after it. What holds is the newest version of each entry, found by
one aggregation over the files; a deletion is a version too.

Passwords and secret keys are not stored: they are given again when a source is looked up.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError, MissingFieldError
from quayline.operators.filters import check_name
from quayline.refs import CsvFormat, DatasetRef, SourceRef
from quayline.session import configure
from quayline.sources import filesystem
from quayline.types import Column, as_columns

KINDS = ("source", "dataset")
_SECRET = ("access_secret", "password")
_ENTRY = "kind string, id string, version bigint, deleted boolean, source_id string, body string"


class RegistryLog:
    """Sources and datasets by id, in a folder that all writers share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = filesystem.qualified(spark, folder).rstrip("/")

    # What is stored

    def entries(self, kind: str) -> DataFrame:
        """``(kind, id, version, deleted, source_id, body)``: the newest version of every entry, deleted ones left out."""
        if kind not in KINDS:
            raise InvalidParameterError(f"a registry holds {' and '.join(KINDS)} entries, not {kind!r}")
        root = f"{self.folder}/{kind}"
        if not filesystem.exists(self.spark, root):
            return self.spark.createDataFrame([], _ENTRY)
        found = self.spark.read.schema(_ENTRY).option("recursiveFileLookup", "true").option("mode", "FAILFAST").json(root)
        newest = found.groupBy("id").agg(F.max_by(F.struct("kind", "version", "deleted", "source_id", "body"), "version").alias("newest"))
        return newest.select("newest.kind", "id", "newest.version", "newest.deleted", "newest.source_id", "newest.body").where("not deleted")

    def versions(self, kind: str, entry_id: str) -> list[int]:
        """All versions of one entry, oldest first."""
        folder = self._place(kind, entry_id)
        if not filesystem.exists(self.spark, folder):
            return []
        return sorted(int(name.removesuffix(".json")) for _, name in filesystem.files(self.spark, folder))

    def _place(self, kind: str, entry_id: str) -> str:
        return f"{self.folder}/{kind}/{check_name(entry_id, f'{kind} id')}"

    def _newest(self, kind: str, entry_id: str) -> dict | None:
        """The newest version of one entry, read from its own folder; None if there is none or it is deleted."""
        versions = self.versions(kind, entry_id)
        if not versions:
            return None
        path = f"{self._place(kind, entry_id)}/{versions[-1]:09d}.json"
        found = self.spark.read.schema(_ENTRY).json(path).first().asDict()
        return None if found["deleted"] else found

    def _put(self, kind: str, entry_id: str, body: dict, version: int, source_id: str | None = None, deleted: bool = False) -> int:
        entry = {"kind": kind, "id": entry_id, "version": version, "deleted": deleted, "source_id": source_id, "body": json.dumps(body)}
        path = f"{self._place(kind, entry_id)}/{version:09d}.json"
        if not filesystem.put_if_absent(self.spark, path, json.dumps(entry) + "\n"):
            raise InvalidParameterError(f"{kind} {entry_id!r} was changed by another writer: version {version} exists")
        return version

    def _create(self, kind: str, entry_id: str, body: dict, source_id: str | None = None) -> int:
        if self._newest(kind, entry_id) is not None:
            raise InvalidParameterError(f"{kind} {entry_id!r} already exists")
        return self._put(kind, entry_id, body, self._next(kind, entry_id), source_id)

    def _next(self, kind: str, entry_id: str) -> int:
        return max(self.versions(kind, entry_id), default=0) + 1

    def _change(self, kind: str, entry_id: str, body: dict, known: int | None, source_id: str | None = None) -> int:
        current = self._known(kind, entry_id)
        if known is not None and known != current["version"]:
            raise InvalidParameterError(f"{kind} {entry_id!r} is at version {current['version']}, not {known}")
        return self._put(kind, entry_id, body, current["version"] + 1, source_id)

    def _known(self, kind: str, entry_id: str) -> dict:
        found = self._newest(kind, entry_id)
        if found is None:
            raise MissingFieldError(f"no {kind} {entry_id!r}")
        return found

    def _delete(self, kind: str, entry_id: str) -> None:
        found = self._known(kind, entry_id)
        self._put(kind, entry_id, {}, found["version"] + 1, found["source_id"], deleted=True)

    # Sources

    def create_source(self, source: SourceRef) -> int:
        """Register a source under its id; returns its version."""
        return self._create("source", source.id, _source_body(source))

    def update_source(self, source: SourceRef, known: int | None = None) -> int:
        """A new version of a source; ``known`` is the version it has to follow, if given."""
        return self._change("source", source.id, _source_body(source), known)

    def source(self, source_id: str, access_secret: str | None = None, password: str | None = None) -> SourceRef:
        """The source of an id, with the secrets given here."""
        body = json.loads(self._known("source", source_id)["body"])
        return SourceRef(**body, access_secret=access_secret, password=password)

    def delete_source(self, source_id: str) -> None:
        """Take out a source that no dataset lies in any more."""
        if self.datasets(source_id).limit(1).count():
            raise InvalidParameterError(f"source {source_id!r} still has datasets")
        self._delete("source", source_id)

    # Datasets

    def create_dataset(self, ref: DatasetRef) -> int:
        """Register a dataset under its id, in a source that is registered; returns its version."""
        self._known("source", ref.source.id)
        return self._create("dataset", ref.id, _dataset_body(ref), ref.source.id)

    def update_dataset(self, ref: DatasetRef, known: int | None = None) -> int:
        """A new version of a dataset; ``known`` is the version it has to follow, if given."""
        self._known("source", ref.source.id)
        return self._change("dataset", ref.id, _dataset_body(ref), known, ref.source.id)

    def dataset(self, dataset_id: str, **secrets) -> DatasetRef:
        """The dataset of an id with its source."""
        found = self._known("dataset", dataset_id)
        return _dataset(found["body"], self.source(found["source_id"], **secrets))

    def delete_dataset(self, dataset_id: str) -> None:
        """Take out a dataset; its files stay."""
        self._delete("dataset", dataset_id)

    def datasets(self, source_id: str) -> DataFrame:
        """``(id, version, name, type, file_format, relative_uri, vendor)`` of the datasets that lie in a source."""
        shape = "name string, type string, file_format string, relative_uri string, vendor string"
        found = self.entries("dataset").where(F.col("source_id") == source_id)
        return found.select("id", "version", F.from_json("body", shape).alias("body")).select("id", "version", "body.*")

    def datasets_of(self, source_id: str, **secrets) -> list[DatasetRef]:
        """References to the datasets that lie in a source, by id."""
        source = self.source(source_id, **secrets)
        found = self.entries("dataset").where(F.col("source_id") == source_id).select("id", "body").orderBy("id")
        return [_dataset(r["body"], source) for r in found.collect()]


def _source_body(source: SourceRef) -> dict:
    check_name(source.id, "source id")
    return {f.name: getattr(source, f.name) for f in fields(source) if f.name not in _SECRET}


def _dataset_body(ref: DatasetRef) -> dict:
    kept = ("id", "name", "type", "file_format", "relative_uri", "vendor", "partition_columns")
    columns = [[c.name, c.type] for c in as_columns(ref.columns)]
    return {**{k: getattr(ref, k) for k in kept}, "columns": columns, "csv": asdict(ref.csv)}


def _dataset(body: str, source: SourceRef) -> DatasetRef:
    known = json.loads(body)
    columns, csv = [Column(*c) for c in known.pop("columns")], CsvFormat(**known.pop("csv"))
    partition_columns = tuple(known.pop("partition_columns"))
    return replace(DatasetRef.of(source, known.pop("relative_uri"), columns, csv=csv, **known), partition_columns=partition_columns)


def fresh_id(kind: str) -> str:
    """An id no other entry has."""
    return f"{kind}_{uuid.uuid4().hex}"
