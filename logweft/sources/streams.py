"""Log lines as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.functions.parse import valid_text


def rolled_source() -> Column:
    """Name of the log a segment belongs to: ``app.log.20240101_000000.1`` is a segment of ``app.log``."""
    return F.regexp_replace("_metadata.file_name", r"\.\d{8}_\d{6}\.\d+$", "")


def stream_log_lines(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    source: Column | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New lines of a folder into which the producer rolls its segments; each file is read once.

    Columns: ``source``, the place of the line's stretch of text (``segment, offset``) and ``value``.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        (rolled_source() if source is None else source).alias("source"),
        F.col("_metadata.file_path").alias("segment"),
        F.col("_metadata.file_block_start").alias("offset"),
        valid_text(F.col("value")).alias("value"),
    )
