"""Analysis of windows as an operation on a table."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.fixed_values import MODEL_NAME
from logweft.functions.classify import DEFAULT_TYPES, AnalysisTypes, analysis_config, detect_analysis_type, forced_type
from logweft.functions.prompts import META_FIELDS, canned_analysis, processed_at, request_payload, selection_payload, user_prompt
from logweft.operators.lines import recent_logs
from logweft.operators.windows import text_windows
from logweft.session import new_shared_path, remove_shared

#: Request body to answer; one that has a parameter ``timeout`` is also given the type's seconds.
Scorer = Callable[..., str]

# Requests in one file, and bytes of such files (compressed) for one task of a round.
REQUESTS_PER_FILE = 5000
TASK_BYTES = 64 << 20


def window_meta(meta: dict[str, Column], run_ts: str | Column) -> Column:
    """Caller's meta plus the window's index, count, tokens and lines.

    Keys of the caller's own go into the map ``extra``, which is there only if there are any.
    """
    given = {name: meta.get(name, F.lit(None)).cast("string") for name in META_FIELDS}
    given["time_range"] = F.coalesce(given["time_range"], processed_at(run_ts))
    own = [x for name in meta if name not in META_FIELDS for x in (F.lit(name), meta[name].cast("string"))]
    return F.struct(
        *[given[name].alias(name) for name in META_FIELDS],
        *([F.create_map(*own).alias("extra")] if own else []),
        F.col("window_index").cast("int").alias("window_index"),
        F.col("total_windows").cast("int").alias("total_windows"),
        F.col("token_count").cast("long").alias("window_tokens"),
        (F.col("end_line") - F.col("start_line") + 1).cast("long").alias("window_lines"),
    )


def window_prompts(
    windows: DataFrame,
    meta: dict[str, Column],
    run_ts: str | Column,
    forced: str | Column | None = None,
    types: AnalysisTypes = DEFAULT_TYPES,
    model: str = MODEL_NAME,
) -> DataFrame:
    """Windows with ``meta, analysis_type, user_prompt, payload, config``."""
    typed = windows.withColumn("analysis_type", forced_type(forced, detect_analysis_type(F.col("content"), types)))
    described = typed.withColumn("meta", window_meta(meta, run_ts))
    kind = F.col("analysis_type")
    fields = {name: F.col(f"meta.{name}") for name in META_FIELDS}
    return (
        described.withColumn("user_prompt", user_prompt(kind, fields, F.col("content"), types))
        .withColumn("payload", request_payload(kind, F.col("user_prompt"), types, model))
        .withColumn("config", analysis_config(kind, types))
    )


def _score_function(scorer: Scorer):
    try:
        timed = "timeout" in inspect.signature(scorer).parameters
    except ValueError:  # some callables of C have no signature
        timed = False

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers, errors = [], []
            seconds = batch["timeout"] if timed and "timeout" in batch else [None] * len(batch)
            for payload, timeout in zip(batch["payload"], seconds, strict=True):
                try:
                    answers.append(scorer(payload) if timeout is None else scorer(payload, timeout=int(timeout)))
                    errors.append(None)
                except Exception as problem:  # one bad request must not lose the others
                    answers.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield batch.drop(columns=["payload"]).assign(
                analysis=pd.Series(answers, index=batch.index, dtype=object),
                success=[e is None for e in errors],
                error=pd.Series(errors, index=batch.index, dtype=object))

    return score


def _rounds(spark: SparkSession, path: str, most: int) -> list[list[str]]:
    """The files below ``path`` in runs of at most ``most`` bytes, or of one file."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").orderBy("path").collect()
    rounds, size = [], most
    for file, length in files:
        if size + length > most:
            rounds.append([])
            size = 0
        rounds[-1].append(file)
        size += length
    return rounds


def score_payloads(
    requests: DataFrame, scorer: Scorer, max_parallel: int | None = None, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Run ``scorer`` (request body -> answer text) on ``payload`` of every row; failures become rows.

    Seconds in a column ``timeout`` reach a scorer that takes them; it stops its call itself.

    ``max_parallel`` bounds the number of concurrent calls.  So few tasks should not hold all requests: these are
    written to the shared folder and scored in rounds, one after the other, in which a task gets about ``task_bytes``
    of them.  A task may be run again after a loss, so the scorer should not mind a repeated request.
    """
    kept = [f for f in requests.schema.fields if f.name != "payload"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", analysis string, success boolean, error string"
    score = _score_function(scorer)
    if not max_parallel:
        return requests.mapInPandas(score, schema)
    if requests.isStreaming:  # a batch is a round
        return requests.repartition(max_parallel).mapInPandas(score, schema)
    spark = requests.sparkSession
    asked, scored = new_shared_path(spark, "requests"), new_shared_path(spark, "scored")
    requests.write.option("maxRecordsPerFile", REQUESTS_PER_FILE).parquet(asked)
    for files in _rounds(spark, asked, max_parallel * task_bytes):
        part = spark.read.schema(requests.schema).parquet(*files).repartition(max_parallel)
        part.mapInPandas(score, schema).write.mode("append").parquet(scored)
    remove_shared(spark, asked)
    return spark.read.schema(schema).parquet(scored)


def analyze_windows(
    windows: DataFrame,
    meta: dict[str, Column] | None = None,
    run_ts: str | Column | None = None,
    forced: str | Column | None = None,
    types: AnalysisTypes = DEFAULT_TYPES,
    scorer: Scorer | None = None,
    max_parallel: int | None = None,
    model: str = MODEL_NAME,
) -> DataFrame:
    """One analysis record per window: ``source, meta, analysis, analysis_type, success, error``.

    Without a scorer the answers are canned and neither prompts nor contents leave the JVM.
    """
    run_ts = run_ts if run_ts is not None else F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    prompts = window_prompts(windows, meta or {}, run_ts, forced, types, model)
    if scorer is None:
        return prompts.select(
            "source", "meta", canned_analysis(F.col("analysis_type")).alias("analysis"), "analysis_type",
            F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"))
    scored = score_payloads(prompts.select("source", "meta", "analysis_type", "payload", F.col("config.timeout").alias("timeout")), scorer, max_parallel)
    return scored.select("source", "meta", "analysis", "analysis_type", "success", "error")


def selection_text(parsed: DataFrame, n: int, by: list[str] = ("source",), order_by: list[str] = ("line_no",)) -> DataFrame:
    """The last ``n`` raw lines per source as one text; at most ``n`` lines meet in a group."""
    ordered = F.sort_array(F.collect_list(F.struct(*order_by, "raw")))
    return (
        recent_logs(parsed, n, by, order_by).groupBy(*by)
        .agg(F.count(F.lit(1)).alias("log_count"), ordered.alias("_rows"))
        .select(*by, "log_count", F.array_join(F.transform("_rows", lambda r: r["raw"]), "\n").alias("text"))
    )


def analyze_selection(
    parsed: DataFrame,
    n: int,
    by: list[str] = ("source",),
    order_by: list[str] = ("line_no",),
    config: WindowConfig | None = None,
    single_prompt: bool = False,
    scorer: Scorer | None = None,
    **options,
) -> DataFrame:
    """Analyse the last ``n`` records of every source: as one prompt, or through token windows."""
    selected = selection_text(parsed, n, by, order_by)
    source = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    if not single_prompt:
        windows = text_windows(selected, config, source=source, text="text")
        return analyze_windows(windows, scorer=scorer, **options)
    requests = selected.select(
        source.alias("source"), "log_count",
        detect_analysis_type(F.col("text")).alias("analysis_type"), selection_payload(F.col("text")).alias("payload"))
    if scorer is None:
        return requests.select(
            "source", "log_count", "analysis_type", canned_analysis(F.col("analysis_type")).alias("analysis"),
            F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"))
    return score_payloads(requests, scorer, options.get("max_parallel"))
