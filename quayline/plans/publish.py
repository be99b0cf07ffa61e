"""Publish a dataset: write, register, and take both back on failure."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from quayline.errors import InvalidParameterError
from quayline.plans.catalog import DatasetCatalog
from quayline.plans.transfer import WriteResult, write_dataset
from quayline.refs import UPLOAD_TYPES, DatasetRef, resolve
from quayline.sources import filesystem
from quayline.types import as_columns


def check_upload(ref: DatasetRef) -> None:
    """Refuse datasets that cannot be published."""
    if ref.type not in UPLOAD_TYPES:
        raise InvalidParameterError(f"a dataset of type {ref.type!r} cannot be published")
    if ref.type == "table" and not ref.columns:
        raise InvalidParameterError("a dataset of type 'table' needs its columns")


def publish_dataset(
    df: DataFrame, ref: DatasetRef, catalog: DatasetCatalog, slice_bytes: int | None = None, **options
) -> WriteResult:
    """Write to a fresh version folder and register it.

    Readers see the dataset only once every file is complete, and nothing is
    renamed, which object stores do slowly. On failure the files and the
    registration are removed and the error is raised again. ``slice_bytes``
    bounds the size of a table's files, which are then moved into place one by one.
    """
    check_upload(ref)
    if slice_bytes and ref.type == "table":
        options["slice_bytes"] = slice_bytes
    dataset_id = ref.id or f"dataset_{uuid.uuid4().hex}"
    version = f"{ref.relative_uri}/{uuid.uuid4().hex}"
    target = DatasetRef(
        ref.source, version, ref.type, ref.file_format, ref.columns, id=dataset_id, name=ref.name, csv=ref.csv
    )
    content = "table" if ref.type == "table" else "raw"
    location = resolve(target, content).location
    spark = df.sparkSession
    if catalog.exists(dataset_id):
        raise InvalidParameterError(f"dataset {dataset_id!r} already exists")
    try:
        result = write_dataset(df, target, content, **options)
        catalog.create(
            dataset_id,
            location,
            ref.file_format,
            as_columns(ref.columns) if ref.type == "table" else None,
            ref.csv,
            name=ref.name,
            type=ref.type,
            source_id=ref.source.id,
            relative_uri=version,
            vendor=ref.vendor,
        )
    except BaseException:
        catalog.delete(dataset_id)
        filesystem.delete(spark, location)
        raise
    return result
