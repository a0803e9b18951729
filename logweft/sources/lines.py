"""Lines from tables: numbering of rows that have an order but no line number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.session import cut_lineage

LINE_BUCKET = 65536


def lines_from_column(texts: DataFrame, source: str | Column, text: str | Column) -> DataFrame:
    """``source, line_no, value`` of texts that hold a whole log each."""
    source = F.col(source) if isinstance(source, str) else source
    text = F.col(text) if isinstance(text, str) else text
    return (
        texts.select(source.cast("string").alias("source"), F.posexplode(F.split(text, "\n")).alias("_at", "value"))
        .select("source", F.col("_at").cast("long").alias("line_no"), "value")
    )


def number_lines(rows: DataFrame, source: str, order_by: list[str]) -> DataFrame:
    """``rows`` plus ``line_no``: 0, 1, 2, ... per ``source`` in the order of ``order_by`` (unique in a source).

    Rows are range-partitioned by source and order, so a source of any size is spread evenly, and written
    once to the checkpoint folder, which fixes their places.  A row's number is its place in its partition
    plus the rows of its source in partitions before; that table has one row per source and partition.
    """
    placed = cut_lineage(
        rows.repartitionByRange(source, *order_by)
        .sortWithinPartitions(source, *order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
    )
    before = Window.partitionBy(source).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy(source, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select(source, "_part", "_first", "_base")
    )
    # Joined on source and partition: even a source with most of the rows has small keys.
    return (
        placed.join(parts, [source, "_part"])
        .withColumn("line_no", F.col("_place") - F.col("_first") + F.col("_base"))
        .drop("_place", "_part", "_first", "_base")
    )


def renumber_lines(
    lines: DataFrame, bucket_lines: int = LINE_BUCKET, then_by: list[str] = (), column: str = "line_no"
) -> DataFrame:
    """Close the gaps that a filter left in ``column`` (or spread out ties, ordered by ``then_by``).

    Lines are counted within buckets of old numbers; a bucket's offset is the sum of the buckets before it.
    """
    bucketed = lines.withColumn("_bucket", F.call_function("div", F.col(column), F.lit(bucket_lines)))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("source", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
        .select("source", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("source", "_bucket").orderBy(column, *then_by)
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, ["source", "_bucket"])
        .withColumn(column, (F.col("_base") + F.col("_rank") - 1).cast("long"))
        .drop("_bucket", "_rank", "_base", *then_by)
    )
