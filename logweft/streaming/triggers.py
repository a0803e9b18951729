"""Stateful triggers per source: when to analyse, and which rows.

State is bounded: counters, errors per service, and the last rows that an analysis may look at, each a state
variable of its own, so that a service or a row is written without the others.  As the decision is taken once per
micro-batch and source, it depends on where batches end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logweft.config import AutoThresholds, MonitorThresholds
from logweft.session import use_state_variables
from logweft.streaming.reduce import merge_shares, source_shares

AUTO_SCHEMA = "source string, reason string, n long, analyzed_count long, dropped_count long, text string"
MONITOR_SCHEMA = (
    "source string, n long, errors long, criticals long, analyze boolean, reason string, buffered long, "
    "analyzed_count long, text string"
)


def _first_met(checks: list[tuple[str, bool]]) -> str | None:
    return next((name for name, met in checks if met), None)


class _RecentRows:
    """The last rows of a source as a list state: appended to while there is room, else written anew."""

    def __init__(self, handle: StatefulProcessorHandle, limit: int):
        self.limit, self.state = limit, handle.getListState("tail", "raw string")

    def add(self, rows: list[str]) -> list[str]:
        held = [row[0] for row in self.state.get()]
        together = (held + rows)[-self.limit:]
        if len(held) + len(rows) <= self.limit:
            self.state.appendList([(row,) for row in rows])
        else:
            self.state.put([(row,) for row in together])
        return together


class _AutoTrigger(StatefulProcessor):
    """Accumulate a source's rows until a limit is met, hand out the last ones, and start anew."""

    def __init__(self, limits: AutoThresholds):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "n long, errors long, criticals long, warnings long")
        self.services = handle.getMapState("services", "service string", "errors long")
        self.recent = _RecentRows(handle, self.limits.max_logs)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        limits, new = self.limits, merge_shares(rows, self.limits.max_logs)
        before = self.totals.get() if self.totals.exists() else (0, 0, 0, 0)
        n, errors, criticals, warnings = (
            old + added for old, added in zip(before, (new.n, new.errors, new.criticals, new.warnings)))
        for service, count in new.service_errors.items():
            held = self.services.getValue((service,)) if self.services.containsKey((service,)) else (0,)
            self.services.updateValue((service,), (held[0] + count,))
        tail = self.recent.add(new.tail)
        reason = None
        if n >= limits.min_logs:
            worst = max((count for count, in self.services.values()), default=0) if self.services.exists() else 0
            reason = _first_met([
                ("error_rate", errors / n >= limits.error_rate),
                ("critical_count", criticals >= limits.critical_count),
                ("warning_count", warnings >= limits.warning_count),
                ("service_errors", worst >= limits.service_errors),
            ])
        if reason is None:
            self.totals.update((n, errors, criticals, warnings))
            return
        for state in (self.totals, self.services, self.recent.state):
            state.clear()
        yield pd.DataFrame({
            "source": [key[0]], "reason": [reason], "n": [n], "analyzed_count": [len(tail)],
            "dropped_count": [n - len(tail)], "text": ["\n".join(tail)],
        })

    def close(self) -> None:
        pass


class _MonitorTrigger(StatefulProcessor):
    """Keep a source's recent rows and decide for every batch whether they are analysed."""

    def __init__(self, limits: MonitorThresholds):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.analyzed = handle.getValueState("analyzed", "at long")
        self.recent = _RecentRows(handle, self.limits.buffer_rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        limits, new = self.limits, merge_shares(rows, self.limits.buffer_rows)
        analyzed_at = self.analyzed.get()[0] if self.analyzed.exists() else None
        buffer = self.recent.add(new.tail)
        reason = _first_met([
            ("row_count", new.n >= limits.analysis_trigger),
            ("error_rate", new.errors / new.n >= limits.error_rate),
            ("critical_count", new.criticals >= limits.critical_count),
            ("first", analyzed_at is None),
            ("interval", analyzed_at is not None
             and new.clock - analyzed_at >= 1000 * limits.analysis_interval_seconds),
        ])
        picked = buffer[-limits.analysis_rows:] if reason else []
        if reason:
            self.analyzed.update((new.clock,))
        yield pd.DataFrame({
            "source": [key[0]], "n": [new.n], "errors": [new.errors], "criticals": [new.criticals],
            "analyze": [reason is not None], "reason": [reason], "buffered": [len(buffer)],
            "analyzed_count": [len(picked)], "text": ["\n".join(picked) if reason else None],
        })

    def close(self) -> None:
        pass


def _with_state(shares: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    use_state_variables(shares.sparkSession)
    return shares.groupBy("source").transformWithStateInPandas(processor, schema, "Append", "None")


def auto_trigger(lines: DataFrame, thresholds: AutoThresholds = AutoThresholds()) -> DataFrame:
    """Selections of rows to analyse from a stream of ``stream_log_lines``, one row per firing."""
    fired = _with_state(source_shares(lines, thresholds.max_logs), _AutoTrigger(thresholds), AUTO_SCHEMA)

    def time_of(line: int):
        return F.expr(f"try_cast(substring(element_at(split(text, '\\n'), {line}), 1, 19) AS timestamp_ntz)")

    return fired.withColumn("start", time_of(1)).withColumn("end", time_of(-1))


def monitor_trigger(lines: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """Decision, size of the recent-row buffer and rows to analyse, per micro-batch and source with new rows."""
    return _with_state(source_shares(lines, thresholds.buffer_rows), _MonitorTrigger(thresholds), MONITOR_SCHEMA)


def recent_buffer(lines: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """Rows kept per source, and the last of them where they are to be analysed."""
    return monitor_trigger(lines, thresholds).select("source", "buffered", "analyzed_count", "text")
