"""Token windows over log lines, and operators on windows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.functions.tokens import count_tokens, simple_tokens
from logweft.operators.packing import Budget, pack_lists, pack_rows
from logweft.sources.files import read_log_lines
from logweft.sources.lines import lines_from_column

WINDOW_BUCKET = 65536


def _budget(config: WindowConfig) -> Budget:
    return Budget(config.max_tokens, config.keep_tokens, config.carries)


def token_windows(
    lines: DataFrame,
    config: WindowConfig | None = None,
    mode: str = "full",
    chunk_lines: int | None = None,
    content: bool = True,
    zero_tokens: bool | None = None,
    **tuning,
) -> DataFrame:
    """Windows over ``lines(source, line_no, value[, tokens])``, ``line_no`` counting from 0 without gaps.

    ``mode='legacy'`` returns only the ordered contents.  ``content=False`` leaves the contents out, and
    the lines out of the shuffle.  Lines may have no tokens, and any number of such lines may follow each other;
    ``zero_tokens=False`` says that none does, as is known of simple counts.
    """
    config = config or WindowConfig()
    given = "tokens" in lines.columns
    tokens = F.coalesce("tokens", F.lit(0)) if given else F.coalesce(count_tokens(F.col("value"), config), F.lit(0))
    if zero_tokens is None:
        zero_tokens = given or config.tokenizer != "simple"
    rows = lines.select(
        F.col("source").cast("string").alias("source"),
        F.col("line_no").cast("long").alias("pos"),
        tokens.cast("long").alias("tokens"),
        F.coalesce("value", F.lit("")).alias("value") if content else F.lit(None).cast("string").alias("value"),
        F.col("line_no").cast("long").alias("first"),
        F.col("line_no").cast("long").alias("last"),
    )
    windows = pack_rows(rows, _budget(config), chunk_lines, zero_tokens, **tuning)
    if not content:
        windows = windows.drop("content")
    return windows.select("source", "window_index", "content") if mode == "legacy" else windows


def process_log_lines(texts: DataFrame, config: WindowConfig | None = None, **options) -> DataFrame:
    """Windows of in-memory logs (``source, text``, a log per row) in one call."""
    config = config or WindowConfig()
    if config.tokenizer == "simple":
        return text_windows(texts, config, **options)
    return token_windows(lines_from_column(texts, "source", "text"), config, **options)


def process_log_file(
    spark: SparkSession, paths: str | list[str], config: WindowConfig | None = None, glob: str | None = None,
    source: Column | None = None, **options,
) -> DataFrame:
    """Windows of log files in one call."""
    return token_windows(read_log_lines(spark, paths, glob, source), config, **options)


def _bounds_function(budget: Budget):
    spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("tokens", pa.int64())]))

    @F.arrow_udf("array<struct<first: bigint, last: bigint, tokens: bigint>>")
    def bounds(tokens: pa.Array) -> pa.Array:
        sizes = np.diff(tokens.offsets.to_numpy())
        before = np.cumsum(sizes) - sizes
        first, last, total, text = pack_lists(tokens.flatten().to_numpy(zero_copy_only=False), sizes, budget)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(sizes)))])
        structs = pa.StructArray.from_arrays(
            [pa.array(first - before[text]), pa.array(last - before[text]), pa.array(total)],
            fields=list(spans.value_type))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)

    return bounds


def text_windows(
    texts: DataFrame,
    config: WindowConfig | None = None,
    source: str | Column = "source",
    text: str | Column = "text",
    clean: Callable[[Column], Column] | None = None,
    content: bool = True,
) -> DataFrame:
    """Windows over texts that hold a whole log each, one row per source.

    Nothing is shuffled: the lines of a source are an array in its row, only their token counts visit
    Python.  ``clean`` is applied to the array of lines first (see ``lines.clean_array``);
    ``content=False`` leaves the contents out.
    """
    config = config or WindowConfig()
    if config.tokenizer != "simple":
        raise ValueError("text_windows counts simple tokens; use lines_from_column and token_windows for BPE")
    source = F.col(source) if isinstance(source, str) else source
    text = F.col(text) if isinstance(text, str) else text
    lines = F.split(text, "\n")
    if clean is not None:
        lines = clean(lines)
    arrays = texts.filter(text.isNotNull()).select(source.cast("string").alias("source"), lines.alias("lines"))
    bounded = arrays.withColumn("bounds", _bounds_function(_budget(config))(
        F.transform("lines", lambda line: simple_tokens(line))))
    spans = {"start_line": "first", "end_line": "last", "token_count": "tokens"}
    names = [*spans, "content"] if content else list(spans)

    def window(bound: Column) -> Column:
        fields = [bound[field].alias(name) for name, field in spans.items()]
        if content:
            length = bound["last"] - bound["first"] + 1
            part = F.slice("lines", (bound["first"] + 1).cast("int"), length.cast("int"))
            fields.append(F.array_join(part, "\n").alias("content"))
        return F.struct(*fields)

    # Contents are cut inside the array, before it is exploded, so that no row carries all lines along.
    # The outer explode keeps the optimizer from deriving a filter that would evaluate the bounds twice.
    return (
        bounded.select("source", F.size("bounds").alias("total_windows"), F.transform("bounds", window).alias("windows"))
        .select("source", "total_windows", F.posexplode_outer("windows").alias("window_index", "w"))
        .filter(F.col("window_index").isNotNull())
        .select("source", "window_index", "total_windows", *[F.col(f"w.{name}") for name in names])
    )


def window_stats(windows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts over windows, per group of ``by`` or in all; zeros when there are none.

    Lines shared by two windows count in both; ``covered_lines`` counts them once.
    """
    lines = F.col("end_line") - F.col("start_line") + 1
    zero = F.lit(0).cast("long")
    stats = windows.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.coalesce(F.sum("token_count"), zero).alias("total_tokens"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_tokens_per_window"),
        F.coalesce(F.min("token_count"), zero).alias("min_tokens"),
        F.coalesce(F.max("token_count"), zero).alias("max_tokens"),
        F.coalesce(F.sum(lines), zero).alias("total_lines"),
    )
    return stats


def overlap_carry(windows: DataFrame, bucket_windows: int = WINDOW_BUCKET) -> DataFrame:
    """Lines that each window shares with the one before it.

    Windows of a source are compared within buckets that also see the last window of the bucket before, so a
    source of any size is spread.
    """
    bucket = F.call_function("div", F.col("window_index"), F.lit(bucket_windows))
    closes = F.col("window_index") % F.lit(bucket_windows) == bucket_windows - 1
    placed = windows.select("source", "window_index", "start_line", "end_line", bucket.alias("_home")).withColumn(
        "_bucket", F.explode(F.when(closes, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    before = F.lag("end_line").over(Window.partitionBy("source", "_bucket").orderBy("window_index"))
    zero = F.lit(0).cast("long")
    return (
        placed.withColumn("carried_lines", F.greatest(zero, F.coalesce(before - F.col("start_line") + 1, zero)))
        .filter(F.col("_bucket") == F.col("_home"))
        .select("source", "window_index", "start_line", "end_line", "carried_lines")
    )


def covered_lines(windows: DataFrame, bucket_windows: int = WINDOW_BUCKET) -> DataFrame:
    """Distinct lines per source, also where a filter has left gaps between windows.

    A window adds its lines after the last end before it: within a bucket that of the window before, for a bucket's
    first window the last end of the buckets before, of which a source has few.
    """
    placed = windows.select(
        "source", "window_index", "start_line", "end_line",
        F.call_function("div", F.col("window_index"), F.lit(bucket_windows)).alias("_bucket"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("source", "_bucket").agg(F.max("end_line").alias("_end")).select(
        F.col("source").alias("_source"), F.col("_bucket").alias("_of"), F.max("_end").over(earlier).alias("_earlier"))
    before = F.lag("end_line").over(Window.partitionBy("source", "_bucket").orderBy("window_index"))
    joined = placed.withColumn("_before", before).join(
        ends, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_of")))
    added = F.col("end_line") - F.greatest(F.col("start_line") - 1, F.coalesce("_before", "_earlier", F.col("start_line") - 1))
    return joined.groupBy("source").agg(F.sum(F.greatest(F.lit(0).cast("long"), added)).alias("distinct_lines"))


def filter_windows(windows: DataFrame, min_tokens: int | None = None, config: WindowConfig | None = None) -> DataFrame:
    """Windows of at least ``min_tokens``; none or zero means the configured minimum."""
    limit = min_tokens or (config or WindowConfig()).min_tokens
    return windows.filter(F.col("token_count") >= F.lit(limit))


def window_by_index(windows: DataFrame, index: int) -> DataFrame:
    """The window at ``index`` of every source; no row where there is none."""
    return windows.filter(F.col("window_index") == F.lit(index))


def merge_windows(
    windows: DataFrame,
    max_merge_tokens: int | None = None,
    config: WindowConfig | None = None,
    chunk_windows: int | None = None,
    zero_tokens: bool = True,
    **tuning,
) -> DataFrame:
    """Join consecutive windows while their tokens fit; ``window_index`` counts from 0 without gaps
    (``renumber_lines(found, column="window_index")`` closes those of a filter).

    Lines that windows share stay in the content twice.  None or zero means the configured budget.
    ``zero_tokens=False`` says that every window has a token, as windows of simple counts have.
    """
    budget = max_merge_tokens or (config or WindowConfig()).max_tokens
    rows = windows.select(
        "source",
        F.col("window_index").cast("long").alias("pos"),
        F.col("token_count").cast("long").alias("tokens"),
        F.col("content").alias("value"),
        F.col("start_line").alias("first"),
        F.col("end_line").alias("last"),
    )
    return pack_rows(rows, Budget(budget), chunk_windows, zero_tokens, **tuning)
