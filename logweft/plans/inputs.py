"""The given tables as log lines."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.functions.parse import parse_log
from logweft.session import new_shared_path
from logweft.sources.lines import lines_from_column, number_lines

# One text per analysis type, in the order general, database, memory, network, security, performance,
# critical; none holds a keyword of a type before its own.
EVENT_MESSAGES = [
    "Request handled normally",
    "Database pool exhausted",
    "Heap usage above limit",
    "Upstream host unreachable",
    "Unauthorized access blocked",
    "Slow response on endpoint",
    "Node unavailable after restart",
]
EVENT_SERVICES = [f"svc{i}" for i in range(13)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from_column(table(spark, sf_dir, "documents"), "doc_id", "text")


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation are its lines."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("source"), F.col("turn").alias("line_no"), F.col("text").alias("value"))


def _level() -> Column:
    kind = F.col("event_type")
    return (
        F.when((kind == "error") & (F.col("event_id") % 10 == 0), F.lit("CRITICAL"))
        .when(kind == "error", F.lit("ERROR"))
        .when(kind == "signup", F.lit("WARN"))
        .when(kind == "purchase", F.lit("DEBUG"))
        .otherwise(F.lit("INFO"))
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as log lines: ``source, event_ts, event_id, event_type, value``; ordered by (event_ts, event_id)."""
    service = F.concat(F.lit("svc"), (F.col("user_id") % 12).cast("string"))
    message = F.element_at(F.array(*[F.lit(m) for m in EVENT_MESSAGES]), (F.col("event_id") % 7 + 1).cast("int"))
    line = F.concat(
        F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" "), _level(), F.lit(" ["), service, F.lit("] "), message)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("log"), (F.col("user_id") % 16).cast("string")).alias("source"),
        F.col("ts").alias("event_ts"), "event_id", "event_type", line.alias("value"))


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as parsed log records, with ``event_ts`` and ``event_id`` for their order."""
    return parse_log(event_lines(spark, sf_dir))


def numbered_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_lines(event_lines(spark, sf_dir), "source", ["event_ts", "event_id"]).select("source", "line_no", "value")


def land_event_files(spark: SparkSession, sf_dir: str, path: str | None = None, where: Column | None = None) -> str:
    """Write the event lines as text files, one folder per source, in order; returns the folder.

    Ranges are split over tasks, so a large source becomes several segments.  With ``path``, files are added to that
    folder; ``where`` picks events.
    """
    path = path or new_shared_path(spark, "event-logs")
    (
        event_lines(spark, sf_dir).where(F.lit(True) if where is None else where)
        .repartitionByRange("source", "event_ts", "event_id").sortWithinPartitions("source", "event_ts", "event_id")
        .select("source", "value")
        .write.mode("append").partitionBy("source").text(path)
    )
    return path


def landed_source() -> Column:
    """Source name of a landed file."""
    return F.regexp_extract("_metadata.file_path", "source=([^/]+)/", 1)
