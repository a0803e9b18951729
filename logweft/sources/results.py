"""Result files: records written by analyses, read back with their kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.fixed_values import RESULT_FILE_PREFIXES, RESULT_FILES_SHOWN

META_SCHEMA = (
    "struct<service: string, host: string, severity: string, time_range: string, window_index: int, "
    "total_windows: int, window_tokens: bigint, window_lines: bigint>"
)
SUMMARY_SCHEMA = "struct<total: bigint, by_level: map<string, bigint>, by_service: map<string, bigint>>"
# Union of the record forms; absent fields read as null.
RECORD_SCHEMA = (
    f"source string, meta {META_SCHEMA}, analysis string, analysis_type string, analysis_id bigint, timestamp string, "
    f"log_count bigint, log_time_range struct<start: string, end: string>, log_summary {SUMMARY_SCHEMA}, "
    "success boolean, error string, _corrupt string"
)


def _line_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path`` of the files that hold a record per line: some line is a whole object, none opens an array."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.rtrim("value").alias("value"))
    whole = F.col("value").startswith("{") & F.col("value").endswith("}") & F.get_json_object("value", "$").isNotNull()
    return (
        lines.groupBy("path").agg(F.bool_or(whole).alias("whole"), F.bool_or(F.col("value").startswith("[")).alias("array"))
        .where("whole and not array").select("path"))


def read_result_records(spark: SparkSession, paths: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """Every record of JSON result files with its file; arrays give one row per element.

    A file holds one JSON value (``multi_line=True``) or a record per line (``False``, as ``write_results`` writes);
    by default each file is read in the form it has.  Lines that are no JSON are records of kind ``unknown``.

    ``kind`` is ``pipeline`` for window records, ``auto`` for records about a selection, else ``unknown``.
    """
    if multi_line is None:
        by_line, forms = read_result_records(spark, paths, False), _line_files(spark, paths)
        whole = read_result_records(spark, paths, True)
        return by_line.join(forms, "path", "left_semi").unionByName(whole.join(forms, "path", "left_anti"))
    records = (
        spark.read.schema(RECORD_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
        .json(paths)
    )
    kind = (
        F.when(F.col("_corrupt").isNotNull(), F.lit("unknown"))
        .when(F.col("meta").isNotNull(), F.lit("pipeline"))
        .when(F.coalesce(F.col("success").cast("string"), F.col("log_count").cast("string")).isNotNull(), F.lit("auto"))
        .when(F.col("analysis").isNotNull(), F.lit("pipeline"))
        .otherwise(F.lit("unknown"))
    )
    return records.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
        F.col("_metadata.file_size").alias("size"),
        kind.alias("kind"),
        "*",
    )


def read_results(spark: SparkSession, paths: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """One row per result file: its kind, success and analysis (of the first window where it has many).

    A file without a record, such as one holding ``[]``, is ``unknown`` and has no success.  Files of no bytes, which
    Spark's readers pass over, are not listed.
    """
    records = read_result_records(spark, paths, multi_line)
    first = F.struct(
        "kind", "analysis", "meta", "log_summary", "timestamp", "log_count",
        F.when(F.col("kind") == "pipeline", F.lit(True)).otherwise(F.coalesce("success", F.lit(False))).alias("success"),
    )
    found = (
        records.groupBy("path", "file")
        .agg(
            F.min_by(first, F.coalesce("meta.window_index", F.lit(0))).alias("r"),
            F.max("last_modified").alias("last_modified"),
            F.max("size").alias("size"),
        )
        .select("path", "file", "size", "last_modified", F.col("r.kind").alias("type"), "r.analysis", "r.meta", "r.log_summary",
                "r.timestamp", "r.log_count", "r.success")
    )
    files = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("last_modified"))
    empty = files.join(found.select("path"), "path", "left_anti").select(
        "*", F.lit("unknown").alias("type"), F.lit(False).alias("success"))
    return found.unionByName(empty, allowMissingColumns=True)


def latest_results(
    results: DataFrame, n: int = RESULT_FILES_SHOWN, prefixes: list[str] = RESULT_FILE_PREFIXES
) -> DataFrame:
    """The ``n`` newest result files; statistics snapshots, which hold no analysis, are left out."""
    names = "^(" + "|".join(prefixes) + r").*\.json$"
    return (
        results.filter(F.col("file").rlike(names) & F.col("analysis").isNotNull())
        .orderBy(F.desc("last_modified"), "path").limit(n)
    )


def latest_result(results: DataFrame) -> DataFrame:
    """The newest result file."""
    newest = F.struct("last_modified", "path")
    return results.agg(
        F.max_by("file", newest).alias("file"), F.max_by("path", newest).alias("path"),
        F.max("last_modified").alias("last_modified"))


def write_results(records: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Write analysis records, partitioned by analysis type."""
    records.write.mode(mode).format(fmt).partitionBy("analysis_type").save(path)
