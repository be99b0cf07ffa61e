"""Batch-by-batch transfer of a folder that keeps receiving files."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayline.session import configure, scratch_path
from quayline.sinks.csv import write_csv


LATEST_ACKS = 1_000
_ACKS = "batch_id bigint, row_count bigint"


@dataclass(frozen=True)
class Ack:
    """One delivered batch."""

    batch_id: int
    row_count: int


@dataclass
class StreamCopy:
    """A running or finished transfer. ``acks`` are the latest; ``acknowledged`` reads all."""

    query: StreamingQuery | None
    target: str
    acks: deque[Ack] = field(default_factory=lambda: deque(maxlen=LATEST_ACKS))

    def wait(self, timeout: float | None = None) -> "StreamCopy":
        self.query.awaitTermination(timeout)
        return self

    def cancel(self) -> None:
        self.query.stop()


def stream_copy(
    spark: SparkSession,
    source: str | DataFrame,
    schema: T.StructType | None,
    target: str,
    source_format: str = "parquet",
    target_format: str = "parquet",
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
    continuous: str | None = None,
    on_ack=None,
    **source_options,
) -> StreamCopy:
    """Copy new files of ``source`` to ``target``, acknowledging every batch.

    ``source`` is a folder, or a streaming DataFrame such as ``stream_csv`` gives.
    Each batch owns the folder ``batch_id=N`` and overwrites it, so a batch
    repeated after a crash does not duplicate rows; its acknowledgement is a row
    of the table that ``acknowledged`` reads. Without ``continuous``, a
    processing-time interval, the copy ends when it has caught up.
    """
    configure(spark)
    if isinstance(source, DataFrame):
        arriving = source
    else:
        reader = spark.readStream.format(source_format).schema(schema).options(**source_options)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        arriving = reader.load(source)
    copy = StreamCopy(None, target)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        folder = f"{target}/batch_id={batch_id}"
        if target_format == "csv":
            write_csv(rows, folder)
        else:
            rows.write.mode("overwrite").format(target_format).save(folder)
        ack = Ack(batch_id, int(seen.get["rows"]))
        record = batch.sparkSession.createDataFrame([(ack.batch_id, ack.row_count)], _ACKS)
        record.write.mode("overwrite").parquet(f"{ack_table(target)}/batch={batch_id}")
        copy.acks.append(ack)
        if on_ack:
            on_ack(ack)

    writer = arriving.writeStream.foreachBatch(deliver).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream")
    )
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    copy.query = writer.start()
    return copy


def ack_table(target: str) -> str:
    """The folder beside the target that holds every acknowledgement."""
    return f"{target.rstrip('/')}.acks"


def acknowledged(spark: SparkSession, target: str) -> DataFrame:
    """``(batch_id, row_count)`` of every batch a transfer has acknowledged, this run's and earlier ones."""
    return spark.read.schema(_ACKS).parquet(ack_table(target)).select("batch_id", "row_count")
