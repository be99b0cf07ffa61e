"""Session settings and shared scratch space.

The caller owns the ``SparkSession``; these helpers only set the SQL options
the conversions rely on and find a folder every executor can reach.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import quayline
from quayline.errors import MissingParameterError

# Kept for the life of the session: DataFrames are lazy, so restoring an old
# value before the caller runs the plan would change its result.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # GB18030 and UTF-32 are outside Spark's default charset list.
    "spark.sql.legacy.javaCharsets": "true",
    # A partition value such as dt=020 has to stay the text '020'.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Texts and binary chunks can be megabytes each: bound Arrow batches by bytes, not rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session options the readers, writers and conversions need."""
    # Functions run by tasks travel by value: executors need no installed package.
    cloudpickle.register_pickle_by_value(quayline)
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in for it only in local mode, where driver and
    executors share one disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise MissingParameterError("spark.checkpoint.dir must name a folder that all executors share")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="quayline-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{scratch_root(spark)}/quayline-{label}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df, label: str, fmt: str = "parquet"):
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors and saves later jobs
    from recomputing ``df``.
    """
    path = scratch_path(spark, label)
    df.write.format(fmt).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)
