"""Parsing of ``YYYY-MM-DD HH:MM:SS LEVEL [service] message`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.fixed_values import LOG_LINE_PATTERN

# All Unicode white space plus the four separator controls.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


_SPACE = r"[\s\x1c-\x1f]"
# The line format on a line that still has its outer white space: Unicode word characters, only a line feed
# ends the message, and the message is more than white space.
_HEADER, _MESSAGE = LOG_LINE_PATTERN.rsplit(" ", 1)
_UNSTRIPPED = rf"(?Ud)^{_SPACE}*{_HEADER} (?={_MESSAGE})(?s:.*?)[^\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def valid_text(value: Column) -> Column:
    """Text without the bytes that are no UTF-8; valid lines pass untouched."""
    repaired = F.translate(F.make_valid_utf8(value), "\ufffd", "")
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)


def is_log_line(value: Column) -> Column:
    """Whether the line has the format; its date may still be impossible."""
    return F.coalesce(value.rlike(_UNSTRIPPED), F.lit(False))


def _time(line: Column) -> Column:
    """Time of a line without leading white space, null where its date does not exist (there is no year 0)."""
    # A zone-less cast: a zoned one would shift times that a time zone skips.
    return F.when(~line.startswith("0000-"), F.substring(line, 1, 19).try_cast("timestamp_ntz"))


def _fields(line: Column, raw: Column) -> dict[str, Column]:
    """Level, service and message of a line of the format, cut by position: the time has a fixed width,
    and neither level nor service holds a blank or bracket."""
    after_service = F.substring(raw, F.locate("]", raw) + 2, F.length(raw))
    return {
        "level": F.substring_index(F.substring(line, 21, 2147483647), " ", 1),
        "service": F.substring_index(F.substring_index(line, "]", 1), "[", -1),
        "message": F.substring_index(after_service, "\n", 1),
    }


def parse_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Log lines as records ``raw, ts, level, service, message``; ``parse_rejects`` has the other lines.

    The pattern runs once per line, before anything else is computed.
    """
    # Cutting the left end alone is cheap; the right end is cut only for columns that show it.
    line = F.ltrim(F.col(value), F.lit(WHITE_SPACE))
    raw = F.rtrim(F.col("_line"), F.lit(WHITE_SPACE))
    return (
        lines.filter(is_log_line(F.col(value))).withColumn("_line", line).drop(value)
        .withColumn("ts", _time(F.col("_line"))).filter(F.col("ts").isNotNull())
        .withColumn("raw", raw).withColumns(_fields(F.col("_line"), F.col("raw"))).drop("_line")
    )


def with_parse(lines: DataFrame, value: str = "value") -> DataFrame:
    """All ``lines`` plus the fields of a record and ``reason``, which is null for records."""
    matched = lines.withColumn("_ok", is_log_line(F.col(value))).withColumn("raw", strip(F.col(value)))
    raw = F.when(F.col("_ok"), F.col("raw"))
    return (
        matched.withColumn("ts", _time(raw)).withColumns(_fields(raw, raw))
        .withColumn("reason", F.when(~F.col("_ok"), F.lit("no_match"))
                    .when(F.col("ts").isNull(), F.lit("bad_timestamp")))
        .drop("_ok")
    )


def parse_rejects(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are no log lines, with the reason (``no_match``, ``bad_timestamp``)."""
    return (
        with_parse(lines, value).filter(F.col("reason").isNotNull())
        .drop("raw", "ts", "level", "service", "message")
    )
