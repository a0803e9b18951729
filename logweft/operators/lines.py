"""Operators on lines: cleaning, splitting, first and last rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.fixed_values import LEGACY_NOISE_WORDS, LINE_SPLIT_TOKENS, NOISE_WORDS, SIMPLE_CHARS_PER_TOKEN
from logweft.functions.parse import WHITE_SPACE, strip
from logweft.functions.tokens import bpe_counter, count_tokens
from logweft.operators.packing import Budget, pack_lists
from logweft.sources.lines import renumber_lines

# Rows of the last-n operators meet in two steps; this many groups share a source in the first.
TAIL_SALTS = 256


def line_is_kept(line: Column, filters: list[str] | None = None, mode: str = "default", lower_filters: bool = False) -> Column:
    """Whether cleaning keeps a line.

    ``default`` looks for the filter words in the lower-cased line and drops blank lines; words are taken
    as given, so one with a capital never matches unless ``lower_filters``.  ``legacy`` looks in the line
    as it is and keeps blank lines.  No filter words means the standard ones.
    """
    if mode == "legacy":
        words, text = LEGACY_NOISE_WORDS, line
    else:
        words, text = filters or NOISE_WORDS, F.lower(line)
        words = [w.lower() for w in words] if lower_filters else words
    kept = F.lit(True) if mode == "legacy" else strip(line) != ""
    for word in words:
        kept = kept & ~text.contains(word)
    return kept


def _without_end(line: Column, mode: str) -> Column:
    return F.rtrim(line, F.lit("\n" if mode == "legacy" else "\n\r"))


def clean_lines(
    lines: DataFrame, filters: list[str] | None = None, mode: str = "default", lower_filters: bool = False
) -> DataFrame:
    """Lines worth analysing, without line ends; ``line_no`` is kept (see ``renumber_lines``)."""
    return (
        lines.filter(line_is_kept(F.col("value"), filters, mode, lower_filters))
        .withColumn("value", _without_end(F.col("value"), mode))
    )


def clean_array(
    lines: Column, filters: list[str] | None = None, mode: str = "default", lower_filters: bool = False
) -> Column:
    """``clean_lines`` on an array of lines."""
    kept = F.filter(lines, lambda line: line_is_kept(line, filters, mode, lower_filters))
    return F.transform(kept, lambda line: _without_end(line, mode))


def _split_function(limit: int, simple: bool, encoding: str):
    @F.arrow_udf("array<string>")
    def split(lines: pa.Array) -> pa.Array:
        words = [(line or "").split() for line in lines.to_pylist()]
        flat = [word for line in words for word in line]
        costs = np.maximum(1, (np.fromiter(map(len, flat), np.int64, len(flat)) + 1) // SIMPLE_CHARS_PER_TOKEN)
        if not simple:
            count = bpe_counter(encoding)
            costs = np.fromiter((count(word + " ") for word in flat), np.int64, len(flat))
        sizes = np.array([len(line) for line in words], dtype=np.int64)
        first, last, _, line = pack_lists(costs, sizes, Budget(limit))
        # Runs follow each other without gaps, so their starts are the offsets of the pieces' words.
        pieces = pc.binary_join(
            pa.ListArray.from_arrays(pa.array(np.append(first, len(flat)), pa.int32()), pa.array(flat, pa.string())), " ")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(words)))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces)

    return split


def split_large_lines(
    lines: DataFrame, max_line_tokens: int = LINE_SPLIT_TOKENS, config: WindowConfig | None = None
) -> DataFrame:
    """Cut lines over ``max_line_tokens`` into runs of words that fit; a word over it stands alone.

    Words are packed like lines into windows, without overlap.  Only the text of such lines is sent to Python; white
    space collapses in them alone, and one of white space only vanishes.  Lines are numbered anew.
    """
    config = config or WindowConfig()
    simple = config.tokenizer == "simple"
    large = count_tokens(F.col("value"), config) > max_line_tokens
    measured = lines.withColumn("_large", large)
    split = _split_function(max_line_tokens, simple, config.encoding)(F.when(F.col("_large"), F.col("value")))
    pieces = measured.select("source", "line_no", F.posexplode(
        F.when(F.col("_large"), split).otherwise(F.array("value"))).alias("_piece", "value"))
    return renumber_lines(pieces, then_by=["_piece"])


def head_lines(lines: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` lines of every source, numbered from 1, with the source's line count."""
    totals = lines.groupBy("source").agg(F.count(F.lit(1)).alias("total_lines"))
    return (
        lines.filter(F.col("line_no") < n).join(totals, "source")
        .select("source", (F.col("line_no") + 1).alias("number"),
                F.rtrim(F.col("value"), F.lit(WHITE_SPACE)).alias("value"), "total_lines")
    )


def last_rows(rows: DataFrame, n: int, by: list[str], order_by: list[str]) -> DataFrame:
    """The last ``n`` rows per ``by`` in the order of ``order_by``.

    Two steps, so that no task sees more than a small multiple of ``n`` rows of one group however large
    it is: tasks keep their own last rows, groups of tasks meet, then those meet.
    """
    order = [F.desc(c) for c in order_by]
    salted = rows.withColumn("_salt", F.spark_partition_id() % F.lit(TAIL_SALTS))
    first = Window.partitionBy(*by, "_salt").orderBy(*order)
    final = Window.partitionBy(*by).orderBy(*order)
    return (
        salted.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= n).drop("_rank", "_salt")
        .withColumn("_rank", F.row_number().over(final)).filter(F.col("_rank") <= n).drop("_rank")
    )


def recent_logs(parsed: DataFrame, n: int, by: list[str] = ("source",), order_by: list[str] = ("line_no",)) -> DataFrame:
    """The last ``n`` log records of every source."""
    return last_rows(parsed, n, list(by), list(order_by))
