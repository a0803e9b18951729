"""Zone-less times.  Casts between zoned and zone-less times go through the session's zone, which may skip an
hour of a log; these do not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with fractions."""
    return (end - start).cast("interval second").cast("decimal(20, 6)").cast("double")


def as_utc(ts: Column) -> Column:
    """The instant that a zone-less time names in UTC."""
    return F.timestamp_seconds((ts - _epoch()).cast("interval second").cast("decimal(20, 6)"))


def from_utc(instant: Column) -> Column:
    """Zone-less time of day of an instant in UTC, in whole seconds."""
    return _epoch() + F.make_dt_interval(secs=F.unix_seconds(instant))


def iso_text(ts: Column) -> Column:
    """``yyyy-mm-ddThh:mm:ss`` of a zone-less time."""
    return F.translate(ts.cast("string"), " ", "T")
