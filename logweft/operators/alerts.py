"""Threshold alerts and analysis triggers on a finished table; the streams apply them per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.config import AutoThresholds, MonitorThresholds
from logweft.fixed_values import ALERT_CRITICAL, ALERT_ERROR_RATE, ALERT_SERVICE
from logweft.operators.aggregates import is_error

def _rows() -> Column:
    return F.count(F.lit(1))


def error_cells(parsed: DataFrame, by: list[str]) -> DataFrame:
    """Counts per group and service: small, however many rows a group has."""
    return parsed.groupBy(*by, "service").agg(
        _rows().alias("n"),
        F.count_if(is_error()).alias("errors"),
        F.count_if(F.col("level") == "CRITICAL").alias("criticals"),
        F.count_if(F.col("level") == "WARN").alias("warnings"),
    )


def level_totals(parsed: DataFrame, by: list[str] = ()) -> DataFrame:
    """Per group: rows, errors (ERROR and CRITICAL), criticals, warnings, and the worst service's errors."""
    return error_cells(parsed, list(by)).groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        F.coalesce(F.sum("criticals"), F.lit(0)).alias("criticals"),
        F.coalesce(F.sum("warnings"), F.lit(0)).alias("warnings"),
        F.coalesce(F.max("errors"), F.lit(0)).alias("worst_service_errors"),
    )


def alerts_from_cells(cells: DataFrame, by: list[str], thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """Alerts from counts per group and service (columns ``service, n, errors, criticals``)."""
    # Groups and their services in one pass over the cells.
    sets = cells.groupingSets([[*by, "service"], by], *by, "service").agg(
        F.sum("n").alias("n"), F.sum("errors").alias("errors"), F.sum("criticals").alias("criticals"),
        F.grouping("service").alias("_group"))
    group = F.col("_group") == 1
    rate = F.col("errors") / F.col("n")

    def alert(kind: str, when: Column, count: str, rate: Column = None) -> Column:
        return F.struct(
            when.alias("on"), F.lit(kind).alias("kind"), F.col(count).alias("count"),
            (F.lit(None).cast("double") if rate is None else rate).alias("rate"))

    return (
        sets.filter(F.col("n") > 0)
        .select(*by, "service", F.explode(F.array(
            alert("error_rate", group & (rate >= thresholds.error_rate), "errors", rate),
            alert("critical_count", group & (F.col("criticals") >= thresholds.critical_count), "criticals"),
            alert("service_errors", ~group & (F.col("errors") >= thresholds.service_errors), "errors"),
        )).alias("a"))
        .filter("a.on").select(*by, "a.kind", "service", "a.count", "a.rate")
    )


def alerts(parsed: DataFrame, by: list[str] = (), thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """One row per alert: ``kind`` (error_rate, critical_count, service_errors), service, count and rate."""
    return alerts_from_cells(error_cells(parsed, list(by)), list(by), thresholds)


def alert_text() -> Column:
    """Alert rows as a line of text."""
    percent = F.format_string("%.1f", F.bround(F.col("rate") * 100, 1))
    return (
        F.when(F.col("kind") == "error_rate", F.format_string(ALERT_ERROR_RATE, percent))
        .when(F.col("kind") == "critical_count", F.format_string(ALERT_CRITICAL, F.col("count")))
        .otherwise(F.format_string(ALERT_SERVICE, F.col("service"), F.col("count")))
    )


def monitor_reason(seconds_since_last: Column, thresholds: MonitorThresholds = MonitorThresholds()) -> Column:
    """Why the monitor analyses a batch with totals ``n, errors, criticals``; null if it does not.

    ``seconds_since_last`` is null when nothing was analysed before.
    """
    return (
        F.when(F.col("n") <= 0, F.lit(None))
        .when(F.col("n") >= thresholds.analysis_trigger, F.lit("row_count"))
        .when(F.col("errors") / F.col("n") >= thresholds.error_rate, F.lit("error_rate"))
        .when(F.col("criticals") >= thresholds.critical_count, F.lit("critical_count"))
        .when(seconds_since_last.isNull(), F.lit("first"))
        .when(seconds_since_last >= thresholds.analysis_interval_seconds, F.lit("interval"))
    )


def monitor_trigger(
    parsed: DataFrame, by: list[str] = (), seconds_since_last: Column | None = None,
    thresholds: MonitorThresholds = MonitorThresholds(),
) -> DataFrame:
    """Monitor decision per group of ``by``, each group being one batch."""
    since = F.lit(None).cast("double") if seconds_since_last is None else seconds_since_last
    return (
        level_totals(parsed, by).withColumn("reason", monitor_reason(since, thresholds))
        .select(*by, "n", "errors", "criticals", F.col("reason").isNotNull().alias("analyze"), "reason")
    )


def auto_reason(thresholds: AutoThresholds = AutoThresholds()) -> Column:
    """Why accumulated rows with totals as of ``level_totals`` are analysed; null if they are not."""
    return (
        F.when(F.col("n") < thresholds.min_logs, F.lit(None))
        .when(F.col("errors") / F.col("n") >= thresholds.error_rate, F.lit("error_rate"))
        .when(F.col("criticals") >= thresholds.critical_count, F.lit("critical_count"))
        .when(F.col("warnings") >= thresholds.warning_count, F.lit("warning_count"))
        .when(F.col("worst_service_errors") >= thresholds.service_errors, F.lit("service_errors"))
    )


def auto_trigger_batch(
    parsed: DataFrame, by: list[str] = ("source",), thresholds: AutoThresholds = AutoThresholds()
) -> DataFrame:
    """Automatic trigger per group; of the accumulated rows the last ``max_logs`` are analysed, all are cleared."""
    fired = F.col("reason").isNotNull()
    return (
        level_totals(parsed, by).withColumn("reason", auto_reason(thresholds))
        .select(
            *by, "n", "errors", "criticals", "warnings", "worst_service_errors", fired.alias("analyze"), "reason",
            F.when(fired, F.least("n", F.lit(thresholds.max_logs).cast("long"))).otherwise(0).alias("analyzed_count"),
            F.when(fired, F.greatest(F.col("n") - thresholds.max_logs, F.lit(0).cast("long"))).otherwise(0)
            .alias("dropped_count"),
        )
    )
