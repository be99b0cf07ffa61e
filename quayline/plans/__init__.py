"""Whole operations on datasets: read, write, copy, publish, catalog."""

from quayline.plans.catalog import DatasetCatalog
from quayline.plans.publish import check_upload, publish_dataset
from quayline.plans.registry_log import RegistryLog
from quayline.plans.splits import read_splits
from quayline.plans.transfer import (
    UPLOAD_SLICE_BYTES,
    WriteResult,
    acks_by_file,
    check_source,
    copy_dataset,
    infer_schema,
    read_dataset,
    write_dataset,
)

__all__ = [
    "DatasetCatalog",
    "RegistryLog",
    "UPLOAD_SLICE_BYTES",
    "WriteResult",
    "acks_by_file",
    "check_source",
    "check_upload",
    "copy_dataset",
    "infer_schema",
    "publish_dataset",
    "read_dataset",
    "read_splits",
    "write_dataset",
]
