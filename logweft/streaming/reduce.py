"""Per-task reduction of log records before they meet by source.

A stateful step sees all rows of a key in one task.  What the triggers need from them are counts per
service and the last rows, so every task first boils its part down to that; a source with most of a
batch then sends each task's small share only.  Lines come in the order of their stretch of text, so the
last of a stretch are cut off its end, and only stretches are put in order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.functions.parse import parse_log
from logweft.operators.aggregates import is_error

COUNTS = ["n", "errors", "criticals", "warnings"]
SHARE_SCHEMA = (
    "source string, service string, n long, errors long, criticals long, warnings long, "
    "segment string, offset long, seq long, raw string, clock long"
)


class Tail:
    """The last ``limit`` rows of a source.

    Rows belong to stretches of text (segment and offset, segments being named in the order they were rolled) and are
    numbered within; of the stretches, only the newest ones that hold enough rows are kept.
    """

    def __init__(self, limit: int):
        self.limit, self.stretches = limit, {}

    def add(self, segment: str, offset: int, rows: Iterable[tuple[int, str]]) -> None:
        held = self.stretches.setdefault((segment, offset), [])
        held += rows
        if len(held) > self.limit:
            held.sort()
            del held[:-self.limit]
        newer = 0
        for stretch in sorted(self.stretches, reverse=True) if len(self.stretches) > 1 else ():
            if newer >= self.limit:
                del self.stretches[stretch]
            else:
                newer += len(self.stretches[stretch])

    def rows(self) -> list[tuple[str, int, int, str]]:
        """(segment, offset, number, row), oldest first."""
        found = [(*stretch, *row) for stretch in sorted(self.stretches) for row in sorted(self.stretches[stretch])]
        return found[-self.limit:]


def _share_function(limit: int):
    columns = ["source", "service", *COUNTS, "segment", "offset", "seq", "raw", "clock"]

    def share(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, tails, seen, clock = None, {}, 0, 0
        for batch in batches:
            if batch.empty:
                continue
            clock = int(batch["clock"].iloc[0])
            found = batch.groupby(["source", "service"], as_index=False)[COUNTS].sum()
            if counts is not None:
                found = pd.concat([counts, found]).groupby(["source", "service"], as_index=False)[COUNTS].sum()
            counts = found
            lines = batch[["source", "segment", "offset", "raw"]].assign(seq=np.arange(seen, seen + len(batch)))
            seen += len(batch)
            for (source, segment, offset), part in lines.groupby(["source", "segment", "offset"], sort=False):
                last = part.iloc[-limit:]
                tails.setdefault(source, Tail(limit)).add(segment, offset, zip(last["seq"].tolist(), last["raw"]))
        if counts is None:
            return
        yield counts.assign(segment=None, offset=0, seq=0, raw=None, clock=clock)[columns]
        for source, tail in tails.items():
            rows = pd.DataFrame(tail.rows(), columns=["segment", "offset", "seq", "raw"])
            yield rows.assign(source=source, service=None, n=0, errors=0, criticals=0, warnings=0, clock=clock)[columns]

    return share


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def source_shares(lines: DataFrame, rows: int) -> DataFrame:
    """Per task and source: counts per service, and the last ``rows`` records (those rows have ``raw``)."""
    parsed = parse_log(lines).select(
        "source", "segment", "offset", "service", "raw", F.lit(1).cast("long").alias("n"),
        _flag(is_error()).alias("errors"), _flag(F.col("level") == "CRITICAL").alias("criticals"),
        _flag(F.col("level") == "WARN").alias("warnings"),
        # The time of the micro-batch, which a repeated batch sees again.
        F.unix_millis(F.current_timestamp()).alias("clock"))
    return parsed.mapInPandas(_share_function(rows), SHARE_SCHEMA)


@dataclass
class SourceBatch:
    """One source in one micro-batch."""

    n: int = 0
    errors: int = 0
    criticals: int = 0
    warnings: int = 0
    service_errors: Counter = field(default_factory=Counter)
    tail: list[str] = field(default_factory=list)
    clock: int = 0


def merge_shares(shares: Iterator[pd.DataFrame], limit: int) -> SourceBatch:
    """Shares of one source added up as they come, however many tasks they are from."""
    whole, tail = SourceBatch(), Tail(limit)
    for part in shares:
        for name in COUNTS:
            setattr(whole, name, getattr(whole, name) + int(part[name].sum()))
        wrong = part[part["errors"] > 0]
        for service, count in zip(wrong["service"], wrong["errors"]):
            whole.service_errors[service] += int(count)
        lines = part[part["raw"].notna()]
        for (segment, offset), rows in lines.groupby(["segment", "offset"], sort=False):
            tail.add(segment, offset, zip(rows["seq"].tolist(), rows["raw"]))
        whole.clock = max(whole.clock, int(part["clock"].max()))
    whole.tail = [raw for *_, raw in tail.rows()]
    return whole
