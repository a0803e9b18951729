"""Log files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweft.functions.parse import valid_text
from logweft.session import cut_lineage

# A block table of this many rows (40 bytes each) is broadcast; a longer one is joined by shuffle.
BROADCAST_BLOCKS = 500_000


def _text(spark: SparkSession, paths, glob: str | None):
    reader = spark.read.format("text").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths)


def read_log_lines(
    spark: SparkSession, paths: str | list[str], glob: str | None = None, source: Column | None = None
) -> DataFrame:
    """``source, line_no, value`` of text files; ``line_no`` counts from 0 within a source.

    A source is a file, or all files (rolled segments, in the order of their paths) to which ``source``,
    an expression on ``_metadata``, gives the same name.

    Files are read in splits.  A split is one stretch of a file, read in order by one task, so a line's
    number is its place in the split plus the lines of the source's splits before.  A first pass counts
    lines per split; the second reads the text and looks the offset up.  Text is not shuffled for it
    while the table of splits is small enough to broadcast, which is checked.
    Bytes that are no UTF-8 are removed.
    """
    # Both passes must cut files alike: pin what the split size would otherwise take from the cluster's
    # current size.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    path = F.col("_metadata.file_path")
    placed = _text(spark, paths, glob).select(
        (path if source is None else source).alias("source"),
        path.alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
        "value",
    )
    before = Window.partitionBy("source").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut_lineage(
        placed.groupBy("source", "_file", "_block")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select("_file", "_block", "_first", "_base", "_rows", F.col("source").alias("_source"))
    )
    if blocks.count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    # A left join, and columns that need both sides: a filter on them can neither drop files from the scan, which
    # would cut the rest differently, nor make the join an inner one.  What does not fit the first pass fails.
    place = F.col("_place") - F.col("_first")
    lost = F.coalesce((place < 0) | (place >= F.col("_rows")), F.lit(True))
    wrong = F.raise_error(F.concat(F.lit("the files, or settings that cut them, changed between two passes: "), F.col("_file")))
    return placed.drop("source").join(blocks, ["_file", "_block"], "left").select(
        F.when(lost, wrong.cast("string")).otherwise(F.col("_source")).alias("source"),
        F.when(lost, wrong.cast("long")).otherwise(place + F.col("_base")).alias("line_no"),
        valid_text(F.col("value")).alias("value"),
    )


def _plain(path: Column) -> Column:
    """Path of a local file without its scheme, which listings and scans spell differently."""
    return F.regexp_replace(path, "^file:/+", "/")


def _empty_files(spark: SparkSession, reader: DataFrame, filled: DataFrame) -> DataFrame:
    """Files without content, which scans leave out: names from the listing, dates from the file system."""
    names = spark.createDataFrame([(name,) for name in reader.inputFiles()], "source string")
    missing = names.withColumn("key", _plain(F.col("source"))).join(filled, F.col("key") == filled["source"], "left_anti")
    rows = []
    for (name,) in missing.select(names["source"]).collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        rows.append((name, path.getName(), 0, status.getModificationTime()))
    empty = spark.createDataFrame(rows, "source string, file string, size long, ms long")
    return empty.select(_plain(F.col("source")).alias("source"), "file", "size", F.timestamp_millis("ms").alias("last_modified"))


def _listing(spark: SparkSession, paths, glob: str | None) -> DataFrame:
    """One row per file, also for empty ones; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(paths)
    filled = found.select(
        _plain(F.col("path")).alias("source"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )
    return filled.unionByName(_empty_files(spark, found, filled))


def find_logs(spark: SparkSession, paths: str | list[str], glob: str = "*.{log,txt}") -> DataFrame:
    """Names of log files, sorted."""
    return _listing(spark, paths, glob).select("file", "source").orderBy("file")


def file_stats(
    spark: SparkSession, paths: str | list[str], glob: str | None = None, expected: DataFrame | None = None
) -> DataFrame:
    """Size, line count and time of last change per file.

    ``expected(file)`` adds files that do not exist with zeros and null.
    """
    counts = (
        _text(spark, paths, glob).groupBy(F.col("_metadata.file_path").alias("source"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    stats = (
        _listing(spark, paths, glob).join(counts.withColumn("source", _plain(F.col("source"))), "source", "left")
        .select("source", "file", "size", F.coalesce("lines", F.lit(0).cast("long")).alias("lines"), "last_modified")
    )
    if expected is None:
        return stats
    return expected.join(stats, "file", "left").select(
        "source", "file",
        F.coalesce("size", F.lit(0).cast("long")).alias("size"),
        F.coalesce("lines", F.lit(0).cast("long")).alias("lines"),
        "last_modified",
    )
