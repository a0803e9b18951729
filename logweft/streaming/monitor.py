"""Running statistics, alerts, analyses and status of log streams."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logweft.config import MonitorThresholds, WindowConfig
from logweft.functions.parse import parse_log
from logweft.functions.times import as_utc, from_utc, iso_text
from logweft.operators.aggregates import is_error, log_summary
from logweft.operators.alerts import alerts, alerts_from_cells
from logweft.operators.analyze import Scorer, analyze_windows
from logweft.operators.windows import text_windows
from logweft.sources.lines import lines_from_column
from logweft.streaming.sinks import BatchFunction


def running_stats(lines: DataFrame) -> DataFrame:
    """Counts per level and service since the start (update mode: changed counts per batch)."""
    return parse_log(lines).groupBy("level", "service").agg(F.count(F.lit(1)).alias("n"))


def batch_alerts(by: list[str] = ("source",), thresholds: MonitorThresholds = MonitorThresholds()) -> BatchFunction:
    """Alerts on each micro-batch of lines, for ``sinks.start(lines, ..., transform=batch_alerts())``."""
    return lambda batch, batch_id: alerts(parse_log(batch), list(by), thresholds)


def event_time_cells(lines: DataFrame, width: str = "1 minute", delay: str = "5 minutes", by: list[str] = ("source",)) -> DataFrame:
    """Counts per interval of log time and service, each given out once, when ``delay`` has passed.

    Unlike counts per micro-batch they do not depend on how lines fell into batches.
    """
    # Watermarks need a zoned time.
    timed = parse_log(lines).withColumn("event_time", as_utc(F.col("ts"))).withWatermark("event_time", delay)
    return (
        timed.groupBy(F.window("event_time", width), *by, "service")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_error()).alias("errors"),
             F.count_if(F.col("level") == "CRITICAL").alias("criticals"))
        .select(from_utc(F.col("window.start")).alias("interval_start"), *by, "service", "n", "errors", "criticals")
    )


def event_time_alerts(by: list[str] = ("source",), thresholds: MonitorThresholds = MonitorThresholds()) -> BatchFunction:
    """Alerts on closed intervals, for a stream of ``event_time_cells``."""
    return lambda batch, batch_id: alerts_from_cells(batch, ["interval_start", *by], thresholds)


def analysis_records(
    selections: DataFrame,
    batch_id: int | Column,
    config: WindowConfig | None = None,
    meta: dict[str, Column] | None = None,
    scorer: Scorer | None = None,
    **options,
) -> DataFrame:
    """Analysis records of selected rows (``source, reason, text``): summary of the rows and every window's answer.

    One record per window of a selection; ``window_index = 0`` gives the first only.
    """
    selections = selections.filter(F.col("text").isNotNull())
    summary = log_summary(parse_log(lines_from_column(selections, "source", "text")))
    answers = analyze_windows(text_windows(selections, config), meta, scorer=scorer, **options)
    batch_id = F.lit(batch_id).cast("long") if isinstance(batch_id, int) else batch_id
    return answers.join(summary, "source", "left").join(selections.select("source", "reason"), "source", "left").select(
        batch_id.alias("analysis_id"), "source", "reason", "meta.window_index", "meta.total_windows",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("total").alias("log_count"),
        F.struct(iso_text(F.col("start")).alias("start"), iso_text(F.col("end")).alias("end")).alias("log_time_range"),
        F.struct("total", "by_level", "by_service").alias("log_summary"),
        "analysis_type", "analysis", "success", "error")


def analyses(config: WindowConfig | None = None, meta: dict[str, Column] | None = None, scorer: Scorer | None = None,
             **options) -> BatchFunction:
    """Analyse what a trigger stream selects, for ``sinks.start(trigger, ..., transform=analyses())``."""
    return lambda batch, batch_id: analysis_records(batch, batch_id, config, meta, scorer, **options)


def periodic_status(spark: SparkSession, report: Callable[[dict], None], seconds: float = 30.0) -> "PeriodicStatus":
    """Report progress of the session's queries from now on; returns the listener, to remove it again."""
    listener = PeriodicStatus(report, seconds)
    spark.streams.addListener(listener)
    return listener


class PeriodicStatus(StreamingQueryListener):
    """Reports progress of the running queries, at most every ``seconds``."""

    def __init__(self, report: Callable[[dict], None], seconds: float = 30.0):
        self.report, self.seconds, self._last = report, seconds, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        now = time.monotonic()
        if now - self._last.get(progress.id, float("-inf")) < self.seconds:
            return
        self._last[progress.id] = now
        self.report({
            "query": progress.name or str(progress.id), "batch_id": progress.batchId, "rows": progress.numInputRows,
            "rows_per_second": progress.processedRowsPerSecond, "timestamp": progress.timestamp,
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
