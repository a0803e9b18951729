"""Option objects.  Each is a frozen bag of literals that ends up inside column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from logweft.fixed_values import (
    AUTO_THRESHOLDS,
    MONITOR_THRESHOLDS,
    WINDOW_DEFAULTS,
)


@dataclass(frozen=True)
class WindowConfig:
    """Size rules of token windows."""

    max_tokens: int = WINDOW_DEFAULTS["max_tokens"]
    overlap_ratio: float = WINDOW_DEFAULTS["overlap_ratio"]
    min_tokens: int = WINDOW_DEFAULTS["min_tokens"]
    tokenizer: str = "simple"
    encoding: str = WINDOW_DEFAULTS["encoding"]

    def __post_init__(self):
        if self.max_tokens <= 0:
            raise ValueError("max_tokens must be positive")
        if not self.overlap_ratio < 1:
            raise ValueError("overlap_ratio must be below 1")
        if self.min_tokens < 0:
            raise ValueError("min_tokens must not be negative")
        if self.tokenizer not in ("simple", "bpe"):
            raise ValueError("tokenizer is 'simple' or 'bpe'")

    @property
    def carries(self) -> bool:
        return self.overlap_ratio > 0

    @property
    def keep_tokens(self) -> int:
        return int(self.max_tokens * self.overlap_ratio) if self.carries else 0


@dataclass(frozen=True)
class MonitorThresholds:
    """Limits of the monitor: alerts on a batch, and when to analyse."""

    error_rate: float = MONITOR_THRESHOLDS["error_rate"]
    critical_count: int = MONITOR_THRESHOLDS["critical_count"]
    service_errors: int = MONITOR_THRESHOLDS["service_errors"]
    analysis_trigger: int = MONITOR_THRESHOLDS["analysis_trigger"]
    analysis_interval_seconds: int = MONITOR_THRESHOLDS["analysis_interval_seconds"]
    analysis_rows: int = MONITOR_THRESHOLDS["analysis_rows"]
    buffer_rows: int = MONITOR_THRESHOLDS["buffer_rows"]


@dataclass(frozen=True)
class AutoThresholds:
    """Limits of the automatic analysis trigger."""

    min_logs: int = AUTO_THRESHOLDS["min_logs"]
    max_logs: int = AUTO_THRESHOLDS["max_logs"]
    error_rate: float = AUTO_THRESHOLDS["error_rate"]
    critical_count: int = AUTO_THRESHOLDS["critical_count"]
    warning_count: int = AUTO_THRESHOLDS["warning_count"]
    service_errors: int = AUTO_THRESHOLDS["service_errors"]
    history_rows: int = AUTO_THRESHOLDS["history_rows"]
