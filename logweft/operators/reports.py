"""Summaries of result tables, runs and request timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _rows() -> Column:
    return F.count(F.lit(1))


def result_rollup(records: DataFrame, by: list[str] = ("file",)) -> DataFrame:
    """Per result file: windows, total length of the analyses, and whether there is any.

    Tasks of one write give files of the same name to several folders; ``by=["path"]`` keeps these apart.
    """
    length = F.coalesce(F.sum(F.length("analysis")), F.lit(0)).cast("long")
    return records.groupBy(*by).agg(
        _rows().alias("windows"), length.alias("analysis_length"), (length > 0).alias("has_analysis"))


def run_report(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Runs, successes, failures, success percentage and mean duration of the successes (0 without any)."""
    ok = F.count_if("success")
    return runs.groupBy(*by).agg(
        _rows().alias("total"),
        ok.alias("successful"),
        (_rows() - ok).alias("failed"),
        (ok * 100.0 / F.greatest(_rows(), F.lit(1))).alias("success_rate"),
        (F.coalesce(F.sum(F.when(F.col("success"), F.col("duration"))), F.lit(0.0)) / F.greatest(ok, F.lit(1)))
        .alias("avg_duration"),
    )


def run_details(runs: DataFrame, success: bool) -> DataFrame:
    """The successful, or the failed, runs."""
    return runs.filter(F.coalesce("success", F.lit(False)) == F.lit(success))


def latency_summary(requests: DataFrame, total_seconds: float, by: list[str] = ()) -> DataFrame:
    """Requests, successes, requests per second, and mean, least and greatest duration of the successes."""
    duration = F.when(F.col("success"), F.col("duration"))
    zero = F.lit(0.0)
    return requests.groupBy(*by).agg(
        _rows().alias("total_requests"),
        F.count_if("success").alias("successful_requests"),
        (_rows() / F.lit(float(total_seconds))).alias("requests_per_second"),
        F.coalesce(F.avg(duration), zero).alias("avg_response_time"),
        F.coalesce(F.min(duration), zero).alias("min_response_time"),
        F.coalesce(F.max(duration), zero).alias("max_response_time"),
    )


def analysis_totals(analyses: DataFrame) -> DataFrame:
    """Analyses, successes, failures, rows analysed and success percentage over ``success, log_count``."""
    ok = F.count_if("success")
    return analyses.agg(
        _rows().alias("total_analyses"),
        ok.alias("successful_analyses"),
        (_rows() - ok).alias("failed_analyses"),
        F.coalesce(F.sum("log_count"), F.lit(0)).cast("long").alias("total_logs_analyzed"),
        (ok * 100.0 / F.greatest(_rows(), F.lit(1))).alias("success_rate"),
    )


def analysis_history(analyses: DataFrame, order_by: list[str], n: int = 100) -> DataFrame:
    """The last ``n`` analyses."""
    return analyses.orderBy(*[F.desc(c) for c in order_by]).limit(n)
