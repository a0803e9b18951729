"""Counts and rates over parsed log records.

All start from partial aggregation on (group, level, service), so a hot service or source costs one row
per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.fixed_values import DASHBOARD_TAIL_LINES, ERROR_LEVELS, LEVELS, SERVICES, TOP_SERVICES
from logweft.functions.parse import with_parse
from logweft.functions.times import seconds_between
from logweft.operators.lines import last_rows

def _rows() -> Column:
    return F.count(F.lit(1))


def is_error() -> Column:
    """Error rates count ERROR and CRITICAL."""
    return F.col("level").isin(*ERROR_LEVELS)


def level_counts(parsed: DataFrame, by: list[str] = ()) -> DataFrame:
    return parsed.groupBy(*by, "level").agg(_rows().alias("n"))


def service_counts(parsed: DataFrame, by: list[str] = ()) -> DataFrame:
    return parsed.groupBy(*by, "service").agg(_rows().alias("n"))


def level_and_service_counts(parsed: DataFrame) -> DataFrame:
    """Counts per level, per service and in all, in one pass; ``dimension`` tells which."""
    cells = parsed.groupBy("level", "service").agg(_rows().alias("n"))
    # Grouping sets over the counted cells, not over the rows.
    sets = cells.groupingSets([["level"], ["service"], []], "level", "service").agg(
        F.sum("n").alias("n"), F.grouping("level").alias("_no_level"), F.grouping("service").alias("_no_service"))
    return sets.select(
        F.when(F.col("_no_level") == 0, F.lit("level")).when(F.col("_no_service") == 0, F.lit("service"))
        .otherwise(F.lit("total")).alias("dimension"),
        F.coalesce("level", "service", F.lit("all")).alias("key"),
        "n",
    )


def error_counts(parsed: DataFrame, by: list[str] = ()) -> DataFrame:
    """Lines of level ERROR only, and of level CRITICAL only."""
    return parsed.groupBy(*by).agg(
        F.count_if(F.col("level") == "ERROR").alias("error_count"),
        F.count_if(F.col("level") == "CRITICAL").alias("critical_count"),
    )


def error_rate(parsed: DataFrame, by: list[str] = ()) -> DataFrame:
    """Share of ERROR and CRITICAL lines; groups without lines have none, over all lines it is 0."""
    return parsed.groupBy(*by).agg(
        _rows().alias("n"),
        F.coalesce(F.count_if(is_error()) / F.nullif(_rows(), F.lit(0)), F.lit(0.0)).alias("error_rate"),
    )


def service_error_counts(parsed: DataFrame, threshold: int = 0, by: list[str] = ()) -> DataFrame:
    """ERROR and CRITICAL lines per service, where at least ``threshold``."""
    return (
        parsed.filter(is_error()).groupBy(*by, "service").agg(_rows().alias("n"))
        .filter(F.col("n") >= threshold)
    )


def known_values(spark: SparkSession, name: str, values: list[str]) -> DataFrame:
    """A fixed list as a table."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def zero_filled_counts(parsed: DataFrame, column: str = "level", values: list[str] | None = None) -> DataFrame:
    """Counts of all levels (or services), with 0 for known ones that did not come."""
    values = values or (LEVELS if column == "level" else SERVICES)
    zeros = known_values(parsed.sparkSession, column, values).withColumn("n", F.lit(0).cast("long"))
    counts = parsed.filter(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("n"))
    return counts.unionByName(zeros).groupBy(column).agg(F.sum("n").alias("n"))


def level_percent(parsed: DataFrame) -> DataFrame:
    """Share of every level in percent."""
    counts = level_counts(parsed)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("level", "n", (F.col("n") * 100.0 / total).alias("percent"))


def top_services(parsed: DataFrame, n: int = TOP_SERVICES) -> DataFrame:
    """The services with most lines; ties in order of name."""
    return service_counts(parsed).orderBy(F.desc("n"), "service").limit(n)


def _count_map(key: str, when: Column) -> Column:
    entries = F.collect_list(F.when(when, F.struct(F.col(key), F.col("n"))))
    return F.map_from_entries(F.array_sort(entries))


def log_summary(parsed: DataFrame, by: list[str] = ("source",), order_by: str = "line_no") -> DataFrame:
    """Per selection: lines, counts by level and by service, times of the first and last arrival."""
    by = list(by)
    cells = parsed.groupBy(*by, "level", "service").agg(
        _rows().alias("n"),
        F.min_by("ts", order_by).alias("start"), F.min(order_by).alias("first"),
        F.max_by("ts", order_by).alias("end"), F.max(order_by).alias("last"),
    )
    sets = cells.groupingSets(
        [[*by, "level"], [*by, "service"], by], *by, "level", "service"
    ).agg(
        F.sum("n").alias("n"), F.min_by("start", "first").alias("start"), F.max_by("end", "last").alias("end"),
        F.grouping("level").alias("_no_level"), F.grouping("service").alias("_no_service"),
    )
    whole = (F.col("_no_level") == 1) & (F.col("_no_service") == 1)
    return sets.groupBy(*by).agg(
        F.max(F.when(whole, F.col("n"))).alias("total"),
        _count_map("level", F.col("_no_level") == 0).alias("by_level"),
        _count_map("service", F.col("_no_service") == 0).alias("by_service"),
        F.max(F.when(whole, F.col("start"))).alias("start"),
        F.max(F.when(whole, F.col("end"))).alias("end"),
    )


def tail_level_stats(
    lines: DataFrame, max_lines: int = DASHBOARD_TAIL_LINES, order_by: list[str] = ("line_no",)
) -> DataFrame:
    """Per source: level counts over the last ``max_lines`` lines, and the count of all its lines."""
    totals = lines.groupBy("source").agg(_rows().alias("total_lines"))
    tail = with_parse(last_rows(lines, max_lines, ["source"], list(order_by)))
    good = F.col("reason").isNull()
    level = F.when(good, F.col("level"))
    counts = tail.groupBy("source").agg(
        F.count_if(good).alias("parsed_lines"),
        *[F.count_if(level == name).alias(name.lower()) for name in LEVELS],
        F.count_if(level == "ERROR").alias("error_count"),
        F.count_if(level == "CRITICAL").alias("critical_count"),
    )
    return totals.join(counts, "source")


def throughput(parsed: DataFrame, start: Column | None = None, end: Column | None = None, ts: str = "ts") -> DataFrame:
    """Lines per second from ``start`` to ``end`` (default: first to last line); 0 when no time passed."""
    bounds = parsed.agg(_rows().alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    seconds = seconds_between(F.col("lo") if start is None else start, F.col("hi") if end is None else end)
    return bounds.select("n", F.when(seconds > 0, F.col("n") / seconds).otherwise(F.lit(0.0)).alias("per_second"))
