"""Sinks: tables of micro-batches that a repeated batch overwrites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchFunction = Callable[[DataFrame, int], DataFrame]


def batch_table(path: str, transform: BatchFunction | None = None, fmt: str = "parquet"):
    """A ``foreachBatch`` function that stores each batch (after ``transform``) under ``batch_id=<n>``.

    A batch that Spark runs again replaces what it wrote before.  With ``transform`` the batch is kept while it is
    written, so that a stateful step before it runs once, however often ``transform`` uses the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist() if transform else batch
        try:
            frame = transform(rows, batch_id) if transform else rows
            frame.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
        finally:
            if transform:
                rows.unpersist()

    return write


def write_reports(path: str, transform: BatchFunction | None = None):
    """``batch_table`` as JSON reports, one folder per batch."""
    return batch_table(path, transform, "json")


def start(
    frame: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
    transform: BatchFunction | None = None, fmt: str = "parquet", available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Run a stream into a batch table; with ``available_now`` over what is there, then stop."""
    writer: DataStreamWriter = (
        frame.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
        .foreachBatch(batch_table(path, transform, fmt))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All batches of a table, with their ``batch_id``."""
    return spark.read.format(fmt).load(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def latest_per_key(table: DataFrame, keys: list[str]) -> DataFrame:
    """The last value written per key, for tables fed in update mode."""
    values = [c for c in table.columns if c not in (*keys, "batch_id")]
    return (
        table.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(*keys, "_v.*")
    )
