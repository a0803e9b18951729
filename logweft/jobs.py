"""Whole runs in one call: files to analyses, and the two kinds of watch over a growing log."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logweft.config import AutoThresholds, MonitorThresholds, WindowConfig
from logweft.operators.analyze import analyze_windows
from logweft.operators.windows import process_log_file
from logweft.sources.results import write_results
from logweft.sources.streams import stream_log_lines
from logweft.streaming import monitor, sinks, triggers


def analyze_log_files(
    spark: SparkSession,
    paths: str | list[str],
    out: str,
    meta: dict[str, Column] | None = None,
    forced: str | None = None,
    config: WindowConfig | None = None,
    glob: str | None = None,
    source: Column | None = None,
    fmt: str = "json",
    mode: str = "errorifexists",
    **options,
) -> None:
    """Read log files, analyse every window and write the records; ``options`` go to ``analyze_windows``."""
    found = process_log_file(spark, paths, config, glob, source)
    write_results(analyze_windows(found, meta, forced=forced, **options), out, fmt, mode)


def monitor_logs(
    spark: SparkSession,
    path: str,
    out: str,
    thresholds: MonitorThresholds = MonitorThresholds(),
    config: WindowConfig | None = None,
    meta: dict[str, Column] | None = None,
    source: Column | None = None,
    available_now: bool = False,
    interval: str = "1 second",
    **options,
) -> list[StreamingQuery]:
    """Watch a folder of log segments: running counts, alerts per poll, and analyses of recent rows.

    Tables ``stats``, ``alerts`` and ``analyses`` below ``out``; each query has its own checkpoint there.
    """
    lines = stream_log_lines(spark, path, source=source)

    def run(name, frame, output_mode="append", transform=None):
        return sinks.start(frame, f"{out}/{name}", f"{out}/checkpoints/{name}", output_mode, transform,
                           available_now=available_now, interval=interval)

    return [
        run("stats", monitor.running_stats(lines), "update"),
        run("alerts", lines, transform=monitor.batch_alerts(thresholds=thresholds)),
        run("analyses", triggers.monitor_trigger(lines, thresholds), transform=monitor.analyses(config, meta, **options)),
    ]


def auto_analyze_logs(
    spark: SparkSession,
    path: str,
    out: str,
    thresholds: AutoThresholds = AutoThresholds(),
    config: WindowConfig | None = None,
    meta: dict[str, Column] | None = None,
    source: Column | None = None,
    available_now: bool = False,
    interval: str = "10 seconds",
    **options,
) -> StreamingQuery:
    """Accumulate each log's rows until they call for an analysis; records go to ``analyses`` below ``out``."""
    fired = triggers.auto_trigger(stream_log_lines(spark, path, source=source), thresholds)
    return sinks.start(fired, f"{out}/analyses", f"{out}/checkpoints/analyses", transform=monitor.analyses(config, meta, **options),
                       available_now=available_now, interval=interval)
