"""Short texts for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweft.fixed_values import ERROR_LEVELS, TIME_AGO_UNITS
from logweft.functions.times import seconds_between


def _fixed(value: Column, digits: int) -> Column:
    # Half-even first: plain formatting would round ties up.
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def human_size(size: Column) -> Column:
    """Bytes as B, KB or MB."""
    return (
        F.when(size < 1024, F.concat(size.cast("string"), F.lit("B")))
        .when(size < 1024 * 1024, F.concat(_fixed(size / 1024, 1), F.lit("KB")))
        .otherwise(F.concat(_fixed(size / (1024 * 1024), 1), F.lit("MB")))
    )


def time_ago(ts: Column, now: Column) -> Column:
    """Time from ``ts`` to ``now`` in seconds, minutes or hours; N/A for null."""
    seconds = seconds_between(ts, now)
    in_seconds, in_minutes, in_hours = TIME_AGO_UNITS
    return (
        F.when(ts.isNull(), F.lit("N/A"))
        .when(seconds < 60, F.concat(_fixed(seconds, 0), F.lit(in_seconds)))
        .when(seconds < 3600, F.concat(_fixed(seconds / 60, 0), F.lit(in_minutes)))
        .otherwise(F.concat(_fixed(seconds / 3600, 1), F.lit(in_hours)))
    )


def preview_text(text: Column, n: int, always: bool = False) -> Column:
    """First ``n`` characters and dots; the dots only where something was cut, unless ``always``."""
    head = F.concat(F.substring(text, 1, n), F.lit("..."))
    return head if always else F.when(F.length(text) > n, head).otherwise(text)


def level_class(level: Column) -> Column:
    """Severity class of a level: red, yellow or green."""
    return (
        F.when(level.isin(*ERROR_LEVELS), F.lit("red"))
        .when(level == "WARN", F.lit("yellow"))
        .otherwise(F.lit("green"))
    )
