"""Registered queries, each with the SQL that checks it where SQL can.

Every query reads whole tables.  Rates and means are rounded to six digits, long texts compared by MD5.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweft import jobs
from logweft.config import WindowConfig
from logweft.fixed_values import (
    DASHBOARD_TAIL_LINES,
    ERROR_LEVELS,
    LEVELS,
    SYSTEM_PROMPTS,
    TASK_BLOCKS,
    TYPE_SETTINGS,
)
from logweft.functions import classify, display, parse, prompts
from logweft.functions.tokens import count_tokens, simple_tokens
from logweft.operators import aggregates, alerts, analyze, lines, reports, windows
from logweft.plans import inputs, oracle
from logweft.plans.oracle import text as lit
from logweft.session import new_shared_path
from logweft.sources import files, follow, results, streams
from logweft.streaming import monitor, sinks, triggers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DOC_CONFIG = WindowConfig(max_tokens=300, overlap_ratio=0.15)
SMALL_CONFIG = WindowConfig(max_tokens=200, overlap_ratio=0.15)
RUN_TS = "2024-02-01T00:00:00.000000"


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def _six(column) -> Column:
    return F.round(column, 6)


def _hashed(frame: DataFrame, *columns: str) -> DataFrame:
    """Long texts replaced by their MD5."""
    for column in columns:
        frame = frame.withColumn(column, F.md5(column))
    return frame


def _doc_windows(spark: SparkSession, sf_dir: str, config: WindowConfig = DOC_CONFIG, content: bool = True) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return windows.text_windows(documents, config, source="doc_id", text="text", content=content)


WITH_DOC_WINDOWS = "WITH RECURSIVE " + oracle.DOCUMENT_LINES + "," + oracle.windows("doc_lines", 300, 0.15)
_WINDOW_COLUMNS = "source, window_index, total_windows, start_line, end_line, token_count, md5(content) AS content"
DETECT = oracle.detect("content")


def _case(column: str, values: dict) -> str:
    def value(v):
        return lit(v) if isinstance(v, str) else str(v)

    return (f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {value(v)}" for k, v in values.items())
            + f" ELSE {value(values['general'])} END")


# ---- flagship -----------------------------------------------------------------------------------------


@query("window_types", WITH_DOC_WINDOWS + f"""
, typed AS (SELECT *, {DETECT} AS analysis_type FROM win)
""" + oracle.stats("analysis_type", "typed"))
def window_types(spark, sf_dir):
    """Documents to windows, windows by topic, statistics per topic."""
    typed = _doc_windows(spark, sf_dir).withColumn(
        "analysis_type", classify.detect_analysis_type(F.col("content")))
    stats = windows.window_stats(typed, ["analysis_type"])
    return stats.withColumn("avg_tokens_per_window", _six("avg_tokens_per_window"))


# ---- lines --------------------------------------------------------------------------------------------


@query("lines_from_column", f"WITH {oracle.DOCUMENT_LINES} SELECT source, i AS line_no, md5(v) AS value FROM doc_lines")
def lines_from_column(spark, sf_dir):
    return _hashed(inputs.document_lines(spark, sf_dir), "value")


@query("number_lines", f"WITH {oracle.NUMBERED_EVENT_LINES} SELECT source, i AS line_no, v AS value FROM ev_numbered")
def number_lines(spark, sf_dir):
    return inputs.numbered_event_lines(spark, sf_dir)


@query("count_tokens", f"""WITH {oracle.DOCUMENT_LINES}
SELECT source, sum({oracle.TOKENS})::BIGINT AS tokens, max({oracle.TOKENS}) AS longest FROM doc_lines GROUP BY source""")
def count_tokens_query(spark, sf_dir):
    tokens = count_tokens(F.col("value"))
    return inputs.document_lines(spark, sf_dir).groupBy("source").agg(
        F.sum(tokens).alias("tokens"), F.max(tokens).alias("longest"))


_CLEAN_INPUT = """
noisy AS (
  SELECT source, i, CASE i % 5 WHEN 1 THEN 'GET /HEALTHZ ' || v WHEN 2 THEN 'readinessProbe ' || v
         WHEN 3 THEN chr(9) || ' ' ELSE v || chr(13) END AS v FROM ev_numbered)"""


def _noisy(spark, sf_dir) -> DataFrame:
    """Event lines, some turned into probe noise and some into blanks."""
    value, turn = F.col("value"), F.col("line_no") % 5
    return inputs.numbered_event_lines(spark, sf_dir).withColumn(
        "value",
        F.when(turn == 1, F.concat(F.lit("GET /HEALTHZ "), value))
        .when(turn == 2, F.concat(F.lit("readinessProbe "), value))
        .when(turn == 3, F.lit("\t ")).otherwise(F.concat(value, F.lit("\r"))))


@query("clean_lines", f"""WITH {oracle.NUMBERED_EVENT_LINES},{_CLEAN_INPUT}
SELECT source, i AS line_no, rtrim(v, chr(10) || chr(13)) AS value FROM noisy WHERE {oracle.kept_line()}""")
def clean_lines(spark, sf_dir):
    return lines.clean_lines(_noisy(spark, sf_dir))


@query("clean_lines_lower_filters", f"""WITH {oracle.NUMBERED_EVENT_LINES},{_CLEAN_INPUT}
SELECT source, i AS line_no, rtrim(v, chr(10) || chr(13)) AS value FROM noisy
WHERE {oracle.kept_line()} AND NOT contains(lower(v), 'readinessprobe')""")
def clean_lines_lower_filters(spark, sf_dir):
    return lines.clean_lines(_noisy(spark, sf_dir), lower_filters=True)


@query("clean_lines_legacy", f"""WITH {oracle.NUMBERED_EVENT_LINES},{_CLEAN_INPUT}
SELECT source, i AS line_no, rtrim(v, chr(10)) AS value FROM noisy
WHERE NOT contains(v, 'healthz') AND NOT contains(v, 'readinessProbe')""")
def clean_lines_legacy(spark, sf_dir):
    return lines.clean_lines(_noisy(spark, sf_dir), mode="legacy")


@query("renumber_lines", f"""WITH {oracle.NUMBERED_EVENT_LINES},{_CLEAN_INPUT}
SELECT source, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS line_no,
       rtrim(v, chr(10) || chr(13)) AS value FROM noisy WHERE {oracle.kept_line()}""")
def renumber_lines(spark, sf_dir):
    return lines.renumber_lines(lines.clean_lines(_noisy(spark, sf_dir)))


# Words of a long line are packed like rows: their cost is that of the word and a blank, and one over the
# limit stands alone, as a line over the budget does.
@query("split_large_lines", f"""WITH RECURSIVE {oracle.DOCUMENT_LINES},
measured AS (SELECT source, i, v, {oracle.TOKENS} AS tok FROM doc_lines),
numbered AS (
  SELECT source || ':' || i AS source, unnest(regexp_extract_all(v, '\\S+')) AS v,
         generate_subscripts(regexp_extract_all(v, '\\S+'), 1) - 1 AS i FROM measured WHERE tok > 50),
word_rows AS (SELECT source, i, v, greatest(1, (length(v) + 1) // 4)::BIGINT AS t FROM numbered),
{oracle.packing("wp", "word_rows", 50, 0, False).strip()},
pieces AS (
  SELECT split_part(r.source, ':', 1) AS source, split_part(r.source, ':', 2)::BIGINT AS i, r.w AS piece,
         string_agg(x.v, ' ' ORDER BY x.i) AS v
  FROM wp_runs r JOIN word_rows x ON x.source = r.source AND x.i BETWEEN r.s AND r.e GROUP BY ALL),
all_lines AS (
  SELECT source, i, 0 AS piece, v FROM measured WHERE tok <= 50 UNION ALL SELECT source, i, piece, v FROM pieces)
SELECT source, row_number() OVER (PARTITION BY source ORDER BY i, piece) - 1 AS line_no, md5(v) AS value FROM all_lines
""")
def split_large_lines(spark, sf_dir):
    return _hashed(lines.split_large_lines(inputs.document_lines(spark, sf_dir), 50), "value")


@query("head_lines", f"""WITH {oracle.DOCUMENT_LINES}
SELECT source, i + 1 AS number, md5(rtrim(v, chr(9) || chr(13) || ' ')) AS value, total_lines
FROM (SELECT *, count(*) OVER (PARTITION BY source) AS total_lines FROM doc_lines) WHERE i < 10""")
def head_lines(spark, sf_dir):
    return _hashed(lines.head_lines(inputs.document_lines(spark, sf_dir), 10), "value")


# ---- parsing ------------------------------------------------------------------------------------------


@query("parse_log", f"""WITH {oracle.EVENT_LOGS}
SELECT source, event_id, ts, level, service, message, raw FROM logs WHERE stamp <> '' AND ts IS NOT NULL""")
def parse_log(spark, sf_dir):
    return inputs.event_logs(spark, sf_dir).select("source", "event_id", "ts", "level", "service", "message", "raw")


_DAMAGED = """
damaged AS (
  SELECT source, event_id,
         CASE event_type WHEN 'signup' THEN replace(v, '2024-01', '2024-13') WHEN 'view' THEN replace(v, '[svc', '[svc-')
              WHEN 'click' THEN '  ' || v || chr(9) ELSE v END AS v FROM ev_lines)"""


def _damaged(spark, sf_dir) -> DataFrame:
    """Event lines, some with impossible dates or services that are no word."""
    kind, value = F.col("event_type"), F.col("value")
    return inputs.event_lines(spark, sf_dir).select("source", "event_id", (
        F.when(kind == "signup", F.replace(value, F.lit("2024-01"), F.lit("2024-13")))
        .when(kind == "view", F.replace(value, F.lit("[svc"), F.lit("[svc-")))
        .when(kind == "click", F.concat(F.lit("  "), value, F.lit("\t"))).otherwise(value)).alias("value"))


@query("parse_rejects", f"""WITH {oracle.EVENT_LINES},{_DAMAGED},
{oracle.parsed("damaged", "d", "source, event_id, v").strip()}
SELECT source, event_id, v AS value, CASE WHEN stamp = '' THEN 'no_match' ELSE 'bad_timestamp' END AS reason
FROM d WHERE stamp = '' OR ts IS NULL""")
def parse_rejects(spark, sf_dir):
    return parse.parse_rejects(_damaged(spark, sf_dir))


@query("parse_damaged", f"""WITH {oracle.EVENT_LINES},{_DAMAGED},
{oracle.parsed("damaged", "d", "source, event_id, v").strip()}
SELECT source, event_id, ts, level, service, message, raw FROM d WHERE stamp <> '' AND ts IS NOT NULL""")
def parse_damaged(spark, sf_dir):
    return parse.parse_log(_damaged(spark, sf_dir)).select(
        "source", "event_id", "ts", "level", "service", "message", "raw")


# ---- windows ------------------------------------------------------------------------------------------


@query("text_windows", f"{WITH_DOC_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win")
def text_windows(spark, sf_dir):
    return _hashed(_doc_windows(spark, sf_dir), "content")


@query("token_windows", f"{WITH_DOC_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win")
def token_windows(spark, sf_dir):
    return _hashed(windows.token_windows(inputs.document_lines(spark, sf_dir), DOC_CONFIG), "content")


@query("token_windows_default", "WITH RECURSIVE " + oracle.DOCUMENT_LINES + "," + oracle.windows("doc_lines", 5000, 0.15)
       + f" SELECT {_WINDOW_COLUMNS} FROM win")
def token_windows_default(spark, sf_dir):
    return _hashed(windows.token_windows(inputs.document_lines(spark, sf_dir)), "content")


WITH_EVENT_WINDOWS = ("WITH RECURSIVE " + oracle.NUMBERED_EVENT_LINES + "," + oracle.windows("ev_numbered", 200, 0.15))


def _event_windows(spark, sf_dir) -> DataFrame:
    # Chunks far below their default length, so that every source spans several.
    return windows.token_windows(inputs.numbered_event_lines(spark, sf_dir), SMALL_CONFIG, chunk_lines=256)


@query("token_windows_long_sources", f"{WITH_EVENT_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win")
def token_windows_long_sources(spark, sf_dir):
    return _hashed(_event_windows(spark, sf_dir), "content")


_CRITICAL_TOKENS = f"CASE WHEN contains(v, ' CRITICAL ') THEN {oracle.TOKENS} ELSE 0 END"


@query("token_windows_open_runs", "WITH RECURSIVE " + oracle.NUMBERED_EVENT_LINES + ","
       + oracle.windows("ev_numbered", 60, 0.5, tokens=_CRITICAL_TOKENS) + f" SELECT {_WINDOW_COLUMNS} FROM win")
def token_windows_open_runs(spark, sf_dir):
    """Windows in which critical lines alone count, so that stretches without tokens reach over chunks."""
    counted = inputs.numbered_event_lines(spark, sf_dir).withColumn("tokens", F.when(
        F.col("value").contains(" CRITICAL "), simple_tokens(F.col("value"))).otherwise(0))
    found = windows.token_windows(
        counted, WindowConfig(max_tokens=60, overlap_ratio=0.5), chunk_lines=128, bucket_rows=64)
    return _hashed(found, "content")


WITH_TURN_WINDOWS = ("WITH RECURSIVE " + oracle.CONVERSATION_LINES + "," + oracle.windows("conv_lines", 200, 0.15))


def _turn_windows(spark, sf_dir) -> DataFrame:
    return windows.token_windows(inputs.conversation_lines(spark, sf_dir), SMALL_CONFIG)


@query("conversation_window_stats", WITH_TURN_WINDOWS + oracle.stats("source"))
def conversation_window_stats(spark, sf_dir):
    """Statistics alone: neither contents nor lines are shuffled."""
    found = windows.token_windows(inputs.conversation_lines(spark, sf_dir), SMALL_CONFIG, content=False)
    return windows.window_stats(found, ["source"]).withColumn("avg_tokens_per_window", _six("avg_tokens_per_window"))


@query("conversation_windows", f"{WITH_TURN_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win")
def conversation_windows(spark, sf_dir):
    return _hashed(_turn_windows(spark, sf_dir), "content")


@query("overlap_carry", "WITH RECURSIVE " + oracle.DOCUMENT_LINES + "," + oracle.windows("doc_lines", 300, 0.5) + """
SELECT source, window_index, start_line, end_line,
       greatest(0, coalesce(lag(end_line) OVER (PARTITION BY source ORDER BY window_index) - start_line + 1, 0))::BIGINT
       AS carried_lines FROM win""")
def overlap_carry(spark, sf_dir):
    """Lines a window shares with the one before it, at half overlap."""
    found = _doc_windows(spark, sf_dir, WindowConfig(max_tokens=300, overlap_ratio=0.5), content=False)
    return windows.overlap_carry(found)


@query("token_windows_no_overlap", "WITH RECURSIVE " + oracle.DOCUMENT_LINES + ","
       + oracle.windows("doc_lines", 300, 0.0) + f" SELECT {_WINDOW_COLUMNS} FROM win")
def token_windows_no_overlap(spark, sf_dir):
    return _hashed(_doc_windows(spark, sf_dir, WindowConfig(max_tokens=300, overlap_ratio=0.0)), "content")


@query("token_windows_legacy", f"{WITH_TURN_WINDOWS} SELECT source, window_index, md5(content) AS content FROM win")
def token_windows_legacy(spark, sf_dir):
    return _hashed(windows.token_windows(inputs.conversation_lines(spark, sf_dir), SMALL_CONFIG, mode="legacy"), "content")


@query("cleaned_windows", f"""WITH RECURSIVE {oracle.NUMBERED_EVENT_LINES},{_CLEAN_INPUT},
cleaned AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS i, rtrim(v, chr(10) || chr(13)) AS v
            FROM noisy WHERE {oracle.kept_line()}),{oracle.windows("cleaned", 200, 0.15)}
SELECT {_WINDOW_COLUMNS} FROM win""")
def cleaned_windows(spark, sf_dir):
    cleaned = lines.renumber_lines(lines.clean_lines(_noisy(spark, sf_dir)))
    return _hashed(windows.token_windows(cleaned, SMALL_CONFIG), "content")


@query("cleaned_text_windows", f"""WITH RECURSIVE {oracle.DOCUMENT_LINES},
cleaned AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS i, v FROM doc_lines
            WHERE {oracle.kept_line()} AND NOT contains(lower(v), 'the ') AND NOT contains(lower(v), ' un ')),
{oracle.windows("cleaned", 300, 0.15).strip()}
SELECT {_WINDOW_COLUMNS} FROM win""")
def cleaned_text_windows(spark, sf_dir):
    """Cleaning with own words inside the rows, then windows."""
    words = ["healthz", "readinessProbe", "livenessProbe", "the ", " un "]
    found = windows.text_windows(
        inputs.table(spark, sf_dir, "documents"), DOC_CONFIG, source="doc_id", text="text",
        clean=lambda array: lines.clean_array(array, words))
    return _hashed(found, "content")


@query("window_stats", WITH_DOC_WINDOWS + oracle.stats("source"))
def window_stats(spark, sf_dir):
    stats = windows.window_stats(_doc_windows(spark, sf_dir, content=False), ["source"])
    return stats.withColumn("avg_tokens_per_window", _six("avg_tokens_per_window"))


@query("covered_lines", f"WITH {oracle.DOCUMENT_LINES} SELECT source, count(*) AS distinct_lines FROM doc_lines GROUP BY source")
def covered_lines(spark, sf_dir):
    return windows.covered_lines(_doc_windows(spark, sf_dir, content=False))


@query("filter_windows", f"{WITH_DOC_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win WHERE token_count >= 100")
def filter_windows(spark, sf_dir):
    return _hashed(windows.filter_windows(_doc_windows(spark, sf_dir), config=DOC_CONFIG), "content")


@query("window_by_index", f"{WITH_DOC_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win WHERE window_index = 2")
def window_by_index(spark, sf_dir):
    return _hashed(windows.window_by_index(_doc_windows(spark, sf_dir), 2), "content")


def _merged_sql(with_windows: str, budget: int) -> str:
    return with_windows + f""",
mg_rows AS (SELECT source, window_index AS i, token_count AS t FROM win),{oracle.packing("mg", "mg_rows", budget, 0, False)}
SELECT r.source, r.w::INTEGER AS window_index, (count(*) OVER (PARTITION BY r.source))::INTEGER AS total_windows,
       min(x.start_line) AS start_line, max(x.end_line) AS end_line, any_value(r.tok) AS token_count,
       md5(string_agg(x.content, chr(10) ORDER BY x.window_index)) AS content
FROM mg_runs r JOIN win x ON x.source = r.source AND x.window_index BETWEEN r.s AND r.e GROUP BY r.source, r.w"""


@query("merge_windows", _merged_sql(WITH_DOC_WINDOWS, 900))
def merge_windows(spark, sf_dir):
    return _hashed(windows.merge_windows(_doc_windows(spark, sf_dir), 900, zero_tokens=False), "content")


@query("merge_windows_long_sources", _merged_sql(WITH_EVENT_WINDOWS, 700))
def merge_windows_long_sources(spark, sf_dir):
    return _hashed(windows.merge_windows(_event_windows(spark, sf_dir), 700, chunk_windows=702, zero_tokens=False), "content")


@query("merge_filtered_windows", WITH_DOC_WINDOWS + f""",
kept AS (SELECT * REPLACE ((row_number() OVER (PARTITION BY source ORDER BY window_index) - 1)::INTEGER AS window_index)
         FROM win WHERE token_count >= 100),
mg_rows AS (SELECT source, window_index AS i, token_count AS t FROM kept),{oracle.packing("mg", "mg_rows", 900, 0, False)}
SELECT r.source, r.w::INTEGER AS window_index, (count(*) OVER (PARTITION BY r.source))::INTEGER AS total_windows,
       min(x.start_line) AS start_line, max(x.end_line) AS end_line, any_value(r.tok) AS token_count,
       md5(string_agg(x.content, chr(10) ORDER BY x.window_index)) AS content
FROM mg_runs r JOIN kept x ON x.source = r.source AND x.window_index BETWEEN r.s AND r.e GROUP BY r.source, r.w""")
def merge_filtered_windows(spark, sf_dir):
    """Windows of some size only, joined again."""
    kept = windows.filter_windows(_doc_windows(spark, sf_dir), config=DOC_CONFIG)
    numbered = lines.renumber_lines(kept, column="window_index")
    return _hashed(windows.merge_windows(numbered, 900, zero_tokens=False), "content")


# ---- types, prompts, analysis -------------------------------------------------------------------------


@query("detect_analysis_type", f"""WITH {oracle.EVENT_LINES}
SELECT event_id, {oracle.detect("v")} AS analysis_type FROM ev_lines""")
def detect_analysis_type(spark, sf_dir):
    return inputs.event_lines(spark, sf_dir).select(
        "event_id", classify.detect_analysis_type(F.col("value")).alias("analysis_type"))


@query("forced_type", f"""WITH {oracle.EVENT_LINES}
SELECT event_id, CASE WHEN event_type = 'error' THEN 'security' ELSE {oracle.detect("v")} END AS analysis_type FROM ev_lines""")
def forced_type(spark, sf_dir):
    forced = F.when(F.col("event_type") == "error", F.lit("security"))
    return inputs.event_lines(spark, sf_dir).select("event_id", classify.forced_type(
        forced, classify.detect_analysis_type(F.col("value"))).alias("analysis_type"))


@query("register_type", f"""WITH {oracle.EVENT_LINES}
SELECT event_id, CASE WHEN contains(lower(v), '[svc7]') THEN 'gateway' ELSE {oracle.detect("v")} END AS analysis_type,
       CASE WHEN contains(lower(v), '[svc7]') THEN 'You know gateways.' ELSE {_case(oracle.detect("v"), SYSTEM_PROMPTS)} END
       AS system_prompt FROM ev_lines""")
def register_type(spark, sf_dir):
    """A type of the user's own that goes before all others."""
    types = classify.DEFAULT_TYPES.register_type(
        "gateway", ["[svc7]"], system_prompt="You know gateways.", before="database")
    return (
        inputs.event_lines(spark, sf_dir)
        .select("event_id", classify.detect_analysis_type(F.col("value"), types).alias("analysis_type"))
        .withColumn("system_prompt", classify.system_prompt(F.col("analysis_type"), types)))


def _typed_events(spark, sf_dir) -> DataFrame:
    return inputs.event_lines(spark, sf_dir).withColumn(
        "analysis_type", classify.detect_analysis_type(F.col("value")))


_TYPED = f"WITH {oracle.EVENT_LINES}, typed AS (SELECT *, {oracle.detect('v')} AS analysis_type FROM ev_lines)"


@query("system_prompt", _TYPED + f"SELECT event_id, {_case('analysis_type', SYSTEM_PROMPTS)} AS system_prompt FROM typed")
def system_prompt(spark, sf_dir):
    return _typed_events(spark, sf_dir).select(
        "event_id", classify.system_prompt(F.col("analysis_type")).alias("system_prompt"))


@query("analysis_config", _TYPED + f"""
SELECT event_id, analysis_type,
       {_case('analysis_type', {k: v[0] for k, v in TYPE_SETTINGS.items()})}::DOUBLE AS temperature,
       {_case('analysis_type', {k: v[1] for k, v in TYPE_SETTINGS.items()})}::INTEGER AS max_tokens,
       {_case('analysis_type', {k: v[2] for k, v in TYPE_SETTINGS.items()})}::INTEGER AS timeout FROM typed""")
def analysis_config(spark, sf_dir):
    return _typed_events(spark, sf_dir).withColumn(
        "config", classify.analysis_config(F.col("analysis_type"))).select("event_id", "analysis_type", "config.*")


_META = {"service": "ordersvc", "host": "node-01", "severity": "error>warning>info"}


def _meta() -> dict:
    return {name: F.lit(value) for name, value in _META.items()}


def _prompt_sql(kind: str, content: str, meta: dict) -> str:
    return (f"""'[META]' || chr(10) || 'service=' || {meta['service']} || chr(10) || 'host=' || {meta['host']} || chr(10)
|| 'time_range=' || {meta['time_range']} || chr(10) || 'severity_top=' || {meta['severity']} || chr(10) || chr(10)
|| '[LOG WINDOW]' || chr(10) || {content} || chr(10) || chr(10) || {_case(kind, TASK_BLOCKS)}""")


_META_SQL = {**{k: lit(v) for k, v in _META.items()}, "time_range": lit(f"processed_at={RUN_TS}Z")}
_TYPED_WINDOWS = WITH_DOC_WINDOWS + f", typed AS (SELECT *, {DETECT} AS analysis_type FROM win)"


@query("user_prompt", _TYPED_WINDOWS + f"""
SELECT source, window_index, analysis_type, md5({_prompt_sql('analysis_type', 'content', _META_SQL)}) AS user_prompt FROM typed""")
def user_prompt(spark, sf_dir):
    found = analyze.window_prompts(_doc_windows(spark, sf_dir), _meta(), RUN_TS)
    return _hashed(found.select("source", "window_index", "analysis_type", "user_prompt"), "user_prompt")


@query("meta_defaults", _TYPED + f"""
SELECT event_id, md5({_prompt_sql('analysis_type', 'v', {
    'service': "CASE WHEN event_type = 'error' THEN source ELSE '[unknown]' END", 'host': "'[unknown]'",
    'severity': "'[unknown]'", 'time_range': "'[unknown]'"})}) AS user_prompt FROM typed""")
def meta_defaults(spark, sf_dir):
    service = F.when(F.col("event_type") == "error", F.col("source"))
    prompt = prompts.user_prompt(F.col("analysis_type"), {"service": service}, F.col("value"))
    return _typed_events(spark, sf_dir).select("event_id", F.md5(prompt).alias("user_prompt"))


@query("window_meta", WITH_DOC_WINDOWS + f"""
SELECT source, 'ordersvc' AS service, 'node-01' AS host, 'error>warning>info' AS severity,
       'processed_at={RUN_TS}Z' AS time_range, window_index, total_windows, token_count AS window_tokens,
       end_line - start_line + 1 AS window_lines FROM win""")
def window_meta(spark, sf_dir):
    return _doc_windows(spark, sf_dir, content=False).select("source", analyze.window_meta(_meta(), RUN_TS).alias("m")).select("source", "m.*")


@query("request_payload", _TYPED_WINDOWS + f"""
SELECT source, window_index, 'Qwen/Qwen2.5-7B-Instruct' AS model, 2::BIGINT AS turns,
       {_case('analysis_type', SYSTEM_PROMPTS)} AS system,
       md5({_prompt_sql('analysis_type', 'content', _META_SQL)}) AS user,
       {_case('analysis_type', {k: v[0] for k, v in TYPE_SETTINGS.items()})}::DOUBLE AS temperature,
       {_case('analysis_type', {k: v[1] for k, v in TYPE_SETTINGS.items()})}::BIGINT AS max_tokens FROM typed""")
def request_payload(spark, sf_dir):
    """Request bodies, read back from their JSON."""
    found = analyze.window_prompts(_doc_windows(spark, sf_dir), _meta(), RUN_TS)
    schema = "model string, messages array<struct<role: string, content: string>>, temperature double, max_tokens bigint"
    return (
        found.select("source", "window_index", F.from_json("payload", schema).alias("b"))
        .select("source", "window_index", "b.model", F.size("b.messages").cast("long").alias("turns"),
                F.col("b.messages")[0]["content"].alias("system"), F.md5(F.col("b.messages")[1]["content"]).alias("user"),
                "b.temperature", "b.max_tokens"))


@query("response_text", f"WITH {oracle.DOCUMENT_LINES} SELECT source, i AS line_no, md5(v) AS answer FROM doc_lines")
def response_text(spark, sf_dir):
    """Every document line as the answer of a chat response, taken out again."""
    message = F.struct(F.struct(F.col("value").alias("content")).alias("message"))
    response = F.to_json(F.struct(F.array(message).alias("choices")))
    return inputs.document_lines(spark, sf_dir).select(
        "source", "line_no", F.md5(prompts.response_text(response)).alias("answer"))


_CANNED = {**{k: prompts.CANNED_ANSWERS["general"] for k in SYSTEM_PROMPTS}, **prompts.CANNED_ANSWERS}


@query("canned_analysis", _TYPED + f"SELECT event_id, {_case('analysis_type', _CANNED)} AS analysis FROM typed")
def canned_analysis(spark, sf_dir):
    return _typed_events(spark, sf_dir).select(
        "event_id", prompts.canned_analysis(F.col("analysis_type")).alias("analysis"))


@query("analyze_windows", _TYPED_WINDOWS + f"""
SELECT source, window_index, token_count AS window_tokens, end_line - start_line + 1 AS window_lines, analysis_type,
       md5({_case('analysis_type', _CANNED)}) AS analysis, true AS success FROM typed""")
def analyze_windows(spark, sf_dir):
    found = analyze.analyze_windows(_doc_windows(spark, sf_dir), _meta(), RUN_TS)
    return found.select("source", "meta.window_index", "meta.window_tokens", "meta.window_lines", "analysis_type",
                        F.md5("analysis").alias("analysis"), "success")


def _echo_scorer(payload: str) -> str:
    """A scorer that answers with the length of the question, and refuses one kind of question."""
    import json

    body = json.loads(payload)
    question = body["messages"][1]["content"]
    if "[MEMORY ANALYSIS TASK]" in question:
        raise ValueError("refused")
    return f"{body['max_tokens']}:{len(question)}"


@query("analyze_windows_scored", _TYPED_WINDOWS + f""", asked AS (
  SELECT *, {_prompt_sql('analysis_type', 'content', _META_SQL)} AS q,
         {_case('analysis_type', {k: v[1] for k, v in TYPE_SETTINGS.items()})} AS budget FROM typed)
SELECT source, window_index, analysis_type, analysis_type <> 'memory' AS success,
       CASE WHEN analysis_type <> 'memory' THEN budget || ':' || length(q) END AS analysis,
       CASE WHEN analysis_type = 'memory' THEN 'ValueError: refused' END AS error FROM asked""")
def analyze_windows_scored(spark, sf_dir):
    """A user's scorer, run on at most four windows at a time; failures become rows."""
    found = analyze.analyze_windows(
        _doc_windows(spark, sf_dir), _meta(), RUN_TS, scorer=_echo_scorer, max_parallel=4)
    return found.select("source", "meta.window_index", "analysis_type", "success", "analysis", "error")


_SELECTION = f"""WITH {oracle.EVENT_LOGS}, picked AS (
  SELECT * FROM logs QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_ts DESC, event_id DESC) <= 50),
texts AS (SELECT source, count(*) AS log_count, string_agg(raw, chr(10) ORDER BY event_ts, event_id) AS content
          FROM picked GROUP BY source)"""


@query("analyze_selection", _SELECTION + f"""
SELECT source, log_count, {DETECT} AS analysis_type, md5({_case(DETECT, _CANNED)}) AS analysis, true AS success FROM texts""")
def analyze_selection(spark, sf_dir):
    """The last 50 records of every log, as one prompt each."""
    found = analyze.analyze_selection(
        inputs.event_logs(spark, sf_dir), 50, order_by=["event_ts", "event_id"], single_prompt=True)
    return found.select("source", "log_count", "analysis_type", F.md5("analysis").alias("analysis"), "success")


@query("analyze_selection_windows", f"""WITH RECURSIVE {oracle.EVENT_LOGS}, picked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_ts DESC, event_id DESC) AS r FROM logs
  QUALIFY r <= 100),
pick AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY event_ts, event_id) - 1 AS i, raw AS v FROM picked),
{oracle.windows("pick", 200, 0.15).strip()}
SELECT source, window_index, total_windows, token_count AS window_tokens, {DETECT} AS analysis_type FROM win""")
def analyze_selection_windows(spark, sf_dir):
    """The last 100 records of every log, through token windows."""
    found = analyze.analyze_selection(
        inputs.event_logs(spark, sf_dir), 100, order_by=["event_ts", "event_id"], config=SMALL_CONFIG, run_ts=RUN_TS)
    return found.select("source", "meta.window_index", "meta.total_windows", "meta.window_tokens", "analysis_type")


# ---- aggregates ---------------------------------------------------------------------------------------

LOGS = f"WITH {oracle.EVENT_LOGS}"


@query("level_counts", LOGS + "SELECT level, count(*) AS n FROM logs GROUP BY level")
def level_counts(spark, sf_dir):
    return aggregates.level_counts(inputs.event_logs(spark, sf_dir))


@query("service_counts", LOGS + "SELECT service, count(*) AS n FROM logs GROUP BY service")
def service_counts(spark, sf_dir):
    return aggregates.service_counts(inputs.event_logs(spark, sf_dir))


@query("level_and_service_counts", LOGS + """
SELECT 'level' AS dimension, level AS key, count(*) AS n FROM logs GROUP BY level
UNION ALL SELECT 'service', service, count(*) FROM logs GROUP BY service
UNION ALL SELECT 'total', 'all', count(*) FROM logs""")
def level_and_service_counts(spark, sf_dir):
    return aggregates.level_and_service_counts(inputs.event_logs(spark, sf_dir))


@query("error_counts", LOGS + """
SELECT source, count_if(level = 'ERROR')::BIGINT AS error_count, count_if(level = 'CRITICAL')::BIGINT AS critical_count
FROM logs GROUP BY source""")
def error_counts(spark, sf_dir):
    return aggregates.error_counts(inputs.event_logs(spark, sf_dir), ["source"])


@query("error_rate", LOGS + f"""
SELECT source, count(*) AS n, round(count_if({oracle.IS_ERROR}) / count(*), 6)::DOUBLE AS error_rate FROM logs GROUP BY source""")
def error_rate(spark, sf_dir):
    found = aggregates.error_rate(inputs.event_logs(spark, sf_dir), ["source"])
    return found.withColumn("error_rate", _six("error_rate"))


@query("service_error_counts", LOGS + f"""
SELECT service, count(*) AS n FROM logs WHERE {oracle.IS_ERROR} GROUP BY service HAVING count(*) >= 5""")
def service_error_counts(spark, sf_dir):
    return aggregates.service_error_counts(inputs.event_logs(spark, sf_dir), 5)


def _values(items) -> str:
    return ", ".join(f"({lit(v)})" for v in items)


@query("zero_filled_counts", LOGS + f"""
SELECT d.level, count(logs.level) AS n FROM (VALUES {_values([*LEVELS, 'TRACE'])}) d(level)
LEFT JOIN logs ON logs.level = d.level GROUP BY d.level""")
def zero_filled_counts(spark, sf_dir):
    return aggregates.zero_filled_counts(inputs.event_logs(spark, sf_dir), "level", [*LEVELS, "TRACE"])


@query("zero_filled_services", LOGS + f"""
SELECT d.service, count(logs.service) AS n FROM (VALUES {_values(inputs.EVENT_SERVICES)}) d(service)
LEFT JOIN logs ON logs.service = d.service GROUP BY d.service""")
def zero_filled_services(spark, sf_dir):
    return aggregates.zero_filled_counts(inputs.event_logs(spark, sf_dir), "service", inputs.EVENT_SERVICES)


@query("level_percent", LOGS + """
SELECT level, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM logs), 6)::DOUBLE AS percent
FROM logs GROUP BY level""")
def level_percent(spark, sf_dir):
    return aggregates.level_percent(inputs.event_logs(spark, sf_dir)).withColumn("percent", _six("percent"))


@query("top_services", LOGS + "SELECT service, count(*) AS n FROM logs GROUP BY service ORDER BY n DESC, service LIMIT 3")
def top_services(spark, sf_dir):
    return aggregates.top_services(inputs.event_logs(spark, sf_dir))


@query("log_summary", LOGS + """,
by_level AS (SELECT source, string_agg(level || '=' || n, ',' ORDER BY level) AS by_level
             FROM (SELECT source, level, count(*) AS n FROM logs GROUP BY ALL) GROUP BY source),
by_service AS (SELECT source, string_agg(service || '=' || n, ',' ORDER BY service) AS by_service
               FROM (SELECT source, service, count(*) AS n FROM logs GROUP BY ALL) GROUP BY source)
SELECT source, count(*) AS total, any_value(by_level) AS by_level, any_value(by_service) AS by_service,
       arg_min(ts, event_id) AS first_ts, arg_max(ts, event_id) AS last_ts
FROM logs JOIN by_level USING (source) JOIN by_service USING (source) GROUP BY source""")
def log_summary(spark, sf_dir):
    def text_of(column: str):
        return F.array_join(F.transform(
            F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")

    found = aggregates.log_summary(inputs.event_logs(spark, sf_dir), order_by="event_id")
    return found.select("source", "total", text_of("by_level").alias("by_level"), text_of("by_service").alias("by_service"),
                        F.col("start").alias("first_ts"), F.col("end").alias("last_ts"))


@query("tail_level_stats", f"""WITH {oracle.EVENT_LINES},{_DAMAGED},
tail AS (SELECT * FROM damaged QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_id DESC) <= {DASHBOARD_TAIL_LINES}),
{oracle.parsed("tail", "d", "source, event_id").strip()},
good AS (SELECT * FROM d WHERE stamp <> '' AND ts IS NOT NULL)
SELECT t.source, any_value(t.total_lines) AS total_lines, count(g.source) AS parsed_lines,
       {", ".join(f"count_if(g.level = '{x}')::BIGINT AS {x.lower()}" for x in LEVELS)},
       count_if(g.level = 'ERROR')::BIGINT AS error_count, count_if(g.level = 'CRITICAL')::BIGINT AS critical_count
FROM (SELECT source, count(*) AS total_lines FROM damaged GROUP BY source) t LEFT JOIN good g ON g.source = t.source
GROUP BY t.source""")
def tail_level_stats(spark, sf_dir):
    return aggregates.tail_level_stats(_damaged(spark, sf_dir), order_by=["event_id"])


@query("recent_logs", LOGS + """
SELECT source, event_id, ts, level, service, message, raw FROM logs
QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_ts DESC, event_id DESC) <= 50""")
def recent_logs(spark, sf_dir):
    found = lines.recent_logs(inputs.event_logs(spark, sf_dir), 50, order_by=["event_ts", "event_id"])
    return found.select("source", "event_id", "ts", "level", "service", "message", "raw")


@query("throughput", LOGS + """
SELECT count(*) AS n, round(count(*) / (epoch(max(ts)) - epoch(min(ts))), 6)::DOUBLE AS per_second FROM logs""")
def throughput(spark, sf_dir):
    found = aggregates.throughput(inputs.event_logs(spark, sf_dir))
    return found.withColumn("per_second", _six("per_second"))


# ---- alerts and triggers ------------------------------------------------------------------------------

_ERR = f"count_if({oracle.IS_ERROR})"


def _alert_sql(by: str) -> str:
    return f"""
SELECT {by}, 'error_rate' AS kind, NULL AS service, {_ERR}::BIGINT AS count, round({_ERR} / count(*), 6)::DOUBLE AS rate
FROM logs GROUP BY {by} HAVING {_ERR} / count(*) >= 0.1
UNION ALL
SELECT {by}, 'critical_count', NULL, count_if(level = 'CRITICAL')::BIGINT, NULL FROM logs GROUP BY {by}
HAVING count_if(level = 'CRITICAL') >= 5
UNION ALL
SELECT {by}, 'service_errors', service, {_ERR}::BIGINT, NULL FROM logs GROUP BY {by}, service HAVING {_ERR} >= 5"""


@query("batch_alerts", LOGS + _alert_sql("source"))
def batch_alerts(spark, sf_dir):
    found = alerts.alerts(inputs.event_logs(spark, sf_dir), ["source"])
    return found.withColumn("rate", _six("rate"))


def _by_hour(spark, sf_dir) -> DataFrame:
    hour = F.concat(F.substring(F.col("ts").cast("string"), 1, 13), F.lit(":00:00"))
    return inputs.event_logs(spark, sf_dir).withColumn("hour", hour.cast("timestamp_ntz"))


_HOURLY = f"WITH {oracle.EVENT_LOGS.replace('logs AS', 'all_logs AS')}, logs AS (SELECT *, date_trunc('hour', ts) AS hour FROM all_logs)"


@query("hourly_alerts", _HOURLY + _alert_sql("hour"))
def hourly_alerts(spark, sf_dir):
    found = alerts.alerts(_by_hour(spark, sf_dir), ["hour"])
    return found.withColumn("rate", _six("rate"))


@query("monitor_trigger", _HOURLY + f""",
g AS (SELECT hour, count(*) AS n, {_ERR}::BIGINT AS errors, count_if(level = 'CRITICAL')::BIGINT AS criticals FROM logs GROUP BY hour),
r AS (SELECT *, CASE WHEN n >= 20 THEN 'row_count' WHEN errors / n >= 0.1 THEN 'error_rate'
                     WHEN criticals >= 5 THEN 'critical_count' END AS reason FROM g)
SELECT hour, n, errors, criticals, reason IS NOT NULL AS analyze, reason FROM r""")
def monitor_trigger(spark, sf_dir):
    """Monitor decision with every hour as a batch, a second after an analysis."""
    return alerts.monitor_trigger(_by_hour(spark, sf_dir), ["hour"], F.lit(1.0))


def _auto_sql(by: str) -> str:
    return f""",
c AS (SELECT {by}, service, count(*) AS n, {_ERR} AS errors, count_if(level = 'CRITICAL') AS criticals,
             count_if(level = 'WARN') AS warnings FROM logs GROUP BY {by}, service),
g AS (SELECT {by}, sum(n)::BIGINT AS n, sum(errors)::BIGINT AS errors, sum(criticals)::BIGINT AS criticals,
             sum(warnings)::BIGINT AS warnings, max(errors)::BIGINT AS worst_service_errors FROM c GROUP BY {by}),
r AS (SELECT *, CASE WHEN n < 20 THEN NULL WHEN errors / n >= 0.15 THEN 'error_rate' WHEN criticals >= 3 THEN 'critical_count'
                     WHEN warnings >= 10 THEN 'warning_count' WHEN worst_service_errors >= 5 THEN 'service_errors' END AS reason
      FROM g)
SELECT *, reason IS NOT NULL AS analyze, CASE WHEN reason IS NULL THEN 0 ELSE least(n, 100) END::BIGINT AS analyzed_count,
       CASE WHEN reason IS NULL THEN 0 ELSE greatest(n - 100, 0) END::BIGINT AS dropped_count FROM r"""


@query("auto_trigger_batch", LOGS + _auto_sql("source"))
def auto_trigger_batch(spark, sf_dir):
    return alerts.auto_trigger_batch(inputs.event_logs(spark, sf_dir))


@query("auto_trigger_hourly", _HOURLY + _auto_sql("hour"))
def auto_trigger_hourly(spark, sf_dir):
    return alerts.auto_trigger_batch(_by_hour(spark, sf_dir), ["hour"])


# ---- reports ------------------------------------------------------------------------------------------


def _runs(spark, sf_dir) -> DataFrame:
    """Events as runs: an error is a failed run, its value the duration."""
    return inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), (F.col("event_type") != "error").alias("success"),
        F.concat(F.lit("log"), (F.col("user_id") % 16).cast("string"), F.lit(".log")).alias("log_file"),
        F.col("value").alias("duration"),
        F.when(F.col("event_type").isin("view", "error"), F.lit("model")).otherwise(F.lit("mock")).alias("test_type"))


_RUNS = """WITH runs AS (
  SELECT event_id AS request_id, event_type <> 'error' AS success, 'log' || (user_id % 16) || '.log' AS log_file,
         value AS duration, CASE WHEN event_type IN ('view', 'error') THEN 'model' ELSE 'mock' END AS test_type FROM events)"""


@query("run_report", _RUNS + """
SELECT test_type, count(*) AS total, count_if(success)::BIGINT AS successful, count_if(NOT success)::BIGINT AS failed,
       round(count_if(success) * 100.0 / greatest(count(*), 1), 6)::DOUBLE AS success_rate,
       round(coalesce(sum(duration) FILTER (success), 0) / greatest(count_if(success), 1), 6)::DOUBLE AS avg_duration
FROM runs GROUP BY test_type""")
def run_report(spark, sf_dir):
    found = reports.run_report(_runs(spark, sf_dir), ["test_type"])
    return found.withColumn("success_rate", _six("success_rate")).withColumn("avg_duration", _six("avg_duration"))


@query("run_details", _RUNS + " SELECT * FROM runs WHERE NOT success")
def run_details(spark, sf_dir):
    return reports.run_details(_runs(spark, sf_dir), success=False)


@query("latency_summary", _RUNS + """
SELECT log_file, count(*) AS total_requests, count_if(success)::BIGINT AS successful_requests,
       round(count(*) / 60.0, 6)::DOUBLE AS requests_per_second,
       round(coalesce(avg(duration) FILTER (success), 0), 6)::DOUBLE AS avg_response_time,
       coalesce(min(duration) FILTER (success), 0) AS min_response_time,
       coalesce(max(duration) FILTER (success), 0) AS max_response_time
FROM runs GROUP BY log_file""")
def latency_summary(spark, sf_dir):
    found = reports.latency_summary(_runs(spark, sf_dir), 60.0, ["log_file"])
    return found.withColumn("requests_per_second", _six("requests_per_second")).withColumn(
        "avg_response_time", _six("avg_response_time"))


def _analyses(spark, sf_dir) -> DataFrame:
    """One analysis per log and hour: its rows, and whether it went well (no critical line in it)."""
    return _by_hour(spark, sf_dir).groupBy("source", "hour").agg(
        F.count(F.lit(1)).alias("log_count"), (F.count_if(F.col("level") == "CRITICAL") == 0).alias("success"))


_ANALYSES = _HOURLY + """, analyses AS (
  SELECT source, hour, count(*) AS log_count, count_if(level = 'CRITICAL') = 0 AS success FROM logs GROUP BY source, hour)"""


@query("analysis_totals", _ANALYSES + """
SELECT count(*) AS total_analyses, count_if(success)::BIGINT AS successful_analyses,
       count_if(NOT success)::BIGINT AS failed_analyses, sum(log_count)::BIGINT AS total_logs_analyzed,
       round(count_if(success) * 100.0 / greatest(count(*), 1), 6)::DOUBLE AS success_rate FROM analyses""")
def analysis_totals(spark, sf_dir):
    return reports.analysis_totals(_analyses(spark, sf_dir)).withColumn("success_rate", _six("success_rate"))


@query("analysis_history", _ANALYSES + " SELECT * FROM analyses ORDER BY hour DESC, source DESC LIMIT 100")
def analysis_history(spark, sf_dir):
    return reports.analysis_history(_analyses(spark, sf_dir), ["hour", "source"])


@query("human_size", """
SELECT doc_id, CASE WHEN b < 1024 THEN b || 'B' WHEN b < 1048576 THEN printf('%.1f', b / 1024) || 'KB'
                    ELSE printf('%.1f', b / 1048576) || 'MB' END AS size
FROM (SELECT doc_id, strlen(text) * 97 AS b FROM documents)""")
def human_size(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", display.human_size(F.octet_length("text").cast("long") * 97).alias("size"))


@query("time_ago", """
SELECT event_id, CASE WHEN s < 60 THEN printf('%.0f', s) || '초 전' WHEN s < 3600 THEN printf('%.0f', s / 60) || '분 전'
                      ELSE printf('%.1f', s / 3600) || '시간 전' END AS ago
FROM (SELECT event_id, epoch_us(TIMESTAMP '2024-01-31 00:00:00') / 1e6 - epoch_us(ts) / 1e6 AS s FROM events)""")
def time_ago(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return inputs.table(spark, sf_dir, "events").select("event_id", display.time_ago(F.col("ts"), now).alias("ago"))


@query("preview_text", """
SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview,
       substr(text, 1, 50) || '...' AS short FROM documents""")
def preview_text(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", display.preview_text(F.col("text"), 100).alias("preview"),
        display.preview_text(F.col("text"), 50, always=True).alias("short"))


@query("level_class", LOGS + f"""
SELECT event_id, CASE WHEN level IN ({", ".join(lit(x) for x in ERROR_LEVELS)}) THEN 'red' WHEN level = 'WARN' THEN 'yellow'
                      ELSE 'green' END AS severity FROM logs""")
def level_class(spark, sf_dir):
    return inputs.event_logs(spark, sf_dir).select("event_id", display.level_class(F.col("level")).alias("severity"))


# ---- files --------------------------------------------------------------------------------------------
#
# These write the event lines (or analyses of the documents) below the shared folder first.


@query("read_log_lines", f"WITH {oracle.NUMBERED_EVENT_LINES} SELECT source, i AS line_no, v AS value FROM ev_numbered")
def read_log_lines(spark, sf_dir):
    return files.read_log_lines(spark, inputs.land_event_files(spark, sf_dir), source=inputs.landed_source())


@query("process_log_file", f"{WITH_EVENT_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM win")
def process_log_file(spark, sf_dir):
    found = windows.process_log_file(
        spark, inputs.land_event_files(spark, sf_dir), SMALL_CONFIG, source=inputs.landed_source(), chunk_lines=256)
    return _hashed(found, "content")


def _folder() -> Column:
    return F.regexp_extract("source", "source=([^/]+)/", 1)


@query("find_logs", f"WITH {oracle.EVENT_LINES} SELECT DISTINCT source, true AS is_text FROM ev_lines")
def find_logs(spark, sf_dir):
    """Logs of which at least one file was found."""
    found = files.find_logs(spark, inputs.land_event_files(spark, sf_dir))
    return found.groupBy(_folder().alias("source")).agg(F.bool_and(F.col("file").endswith(".txt")).alias("is_text"))


@query("file_stats", f"""WITH {oracle.EVENT_LINES}
SELECT source, sum(strlen(v) + 1)::BIGINT AS size, count(*) AS lines, true AS dated FROM ev_lines GROUP BY source""")
def file_stats(spark, sf_dir):
    found = files.file_stats(spark, inputs.land_event_files(spark, sf_dir))
    return found.groupBy(_folder().alias("source")).agg(
        F.sum("size").alias("size"), F.sum("lines").alias("lines"),
        F.bool_and(F.col("last_modified").isNotNull()).alias("dated"))


def _land_results(spark, sf_dir) -> str:
    path = new_shared_path(spark, "analysis-results")
    results.write_results(
        analyze.analyze_windows(_doc_windows(spark, sf_dir), _meta(), RUN_TS).drop("success", "error"), path)
    return path


@query("read_result_records", _TYPED_WINDOWS + f"""
SELECT source, window_index, token_count AS window_tokens, analysis_type, md5({_case('analysis_type', _CANNED)}) AS analysis,
       'pipeline' AS kind FROM typed""")
def read_result_records(spark, sf_dir):
    """Records written as JSON, read back and told apart."""
    found = results.read_result_records(spark, _land_results(spark, sf_dir))
    return found.select("source", "meta.window_index", "meta.window_tokens", "analysis_type",
                        F.md5("analysis").alias("analysis"), "kind")


def _type_folder() -> Column:
    return F.regexp_extract("path", "analysis_type=([^/]+)/", 1)


@query("read_results", _TYPED_WINDOWS + f"""
SELECT source, window_index, token_count AS window_tokens, analysis_type, md5({_case('analysis_type', _CANNED)}) AS analysis,
       'pipeline' AS kind, 'pipeline' AS type, true AS success, true AS sized,
       min(window_index) OVER (PARTITION BY analysis_type)::BIGINT AS first_window,
       md5({_case('analysis_type', _CANNED)}) AS file_analysis FROM typed""")
def read_results(spark, sf_dir):
    """Every record beside what is said of its result file; files of an analysis type are taken together where their
    number, which depends on the tasks that wrote them, would tell."""
    path = _land_results(spark, sf_dir)
    of_type = Window.partitionBy(_type_folder(), "type")
    found = results.read_results(spark, path).select(
        "path", "type", "success", (F.col("size") > 0).alias("sized"),
        F.min("meta.window_index").over(of_type).cast("long").alias("first_window"),
        F.md5("analysis").alias("file_analysis"))
    return results.read_result_records(spark, path).select(
        "path", "source", "meta.window_index", "meta.window_tokens", "analysis_type", F.md5("analysis").alias("analysis"),
        "kind").join(found, "path").drop("path")


@query("write_results", _TYPED_WINDOWS + f"""
SELECT source, window_index, analysis_type, md5({_case('analysis_type', _CANNED)}) AS analysis FROM typed""")
def write_results(spark, sf_dir):
    """Records written as Parquet by analysis type, and read back."""
    path = new_shared_path(spark, "analysis-table")
    results.write_results(analyze.analyze_windows(_doc_windows(spark, sf_dir), _meta(), RUN_TS), path, "parquet")
    return spark.read.parquet(path).select("source", "meta.window_index", "analysis_type", F.md5("analysis").alias("analysis"))


@query("result_rollup", _TYPED_WINDOWS + f"""
SELECT analysis_type, count(*) AS windows, sum(length({_case('analysis_type', _CANNED)}))::BIGINT AS analysis_length,
       true AS has_analysis FROM typed GROUP BY analysis_type""")
def result_rollup(spark, sf_dir):
    """Roll-up of result files, files of a type then added up."""
    by_file = reports.result_rollup(results.read_result_records(spark, _land_results(spark, sf_dir)), ["path"])
    return by_file.groupBy(_type_folder().alias("analysis_type")).agg(
        F.sum("windows").alias("windows"), F.sum("analysis_length").alias("analysis_length"),
        F.bool_or("has_analysis").alias("has_analysis"))


@query("analyze_log_files", f"""{WITH_EVENT_WINDOWS}, typed AS (SELECT *, {DETECT} AS analysis_type FROM win)
SELECT window_index, total_windows, token_count AS window_tokens, analysis_type,
       md5({_case('analysis_type', _CANNED)}) AS analysis, 'ordersvc' AS service FROM typed""")
def analyze_log_files(spark, sf_dir):
    """Files to analysis records in one call, read back."""
    out = new_shared_path(spark, "analyzed-files")
    jobs.analyze_log_files(spark, inputs.land_event_files(spark, sf_dir), out, _meta(), config=SMALL_CONFIG,
                           source=inputs.landed_source(), run_ts=RUN_TS)
    found = results.read_result_records(spark, out)
    return found.select("meta.window_index", "meta.total_windows", "meta.window_tokens", "analysis_type",
                        F.md5("analysis").alias("analysis"), "meta.service")


@query("latest_results")
def latest_results(spark, sf_dir):
    """The newest result files (names differ from run to run)."""
    found = results.read_results(spark, _land_results(spark, sf_dir))
    return results.latest_results(found, prefixes=["part-"]).select("file", "size", "type", "success", F.length(
        display.preview_text(F.col("analysis"), 100)).alias("preview_length"))


@query("latest_result", _TYPED_WINDOWS + """
SELECT analysis_type, true AS dated FROM typed WHERE analysis_type = 'general' GROUP BY analysis_type""")
def latest_result(spark, sf_dir):
    """The newest result file, where those of one type are written after all others."""
    path = new_shared_path(spark, "analysis-results")
    records = analyze.analyze_windows(_doc_windows(spark, sf_dir), _meta(), RUN_TS).drop("success", "error")
    results.write_results(records.where("analysis_type <> 'general'"), path)
    results.write_results(records.where("analysis_type = 'general'"), path, mode="append")
    found = results.latest_result(results.read_results(spark, path))
    return found.select(_type_folder().alias("analysis_type"), F.col("last_modified").isNotNull().alias("dated"))


# ---- streams ------------------------------------------------------------------------------------------
#
# Each lands the event lines as segments, runs the stream over them to the end, and returns its table.


def _stream(spark, sf_dir, files_per_batch: int | None = None) -> DataFrame:
    return streams.stream_log_lines(
        spark, inputs.land_event_files(spark, sf_dir), source=inputs.landed_source(),
        max_files_per_trigger=files_per_batch)


def _run(frame: DataFrame, name: str, output_mode: str = "append", transform=None) -> DataFrame:
    spark = frame.sparkSession
    out = new_shared_path(spark, name)
    started = sinks.start(frame, f"{out}/table", f"{out}/checkpoint", output_mode, transform, available_now=True)
    started.awaitTermination()
    return sinks.read_batches(spark, f"{out}/table")


@query("running_stats", LOGS + "SELECT level, service, count(*) AS n FROM logs GROUP BY level, service")
def running_stats(spark, sf_dir):
    """Running counts over several micro-batches; the last value per key."""
    table = _run(monitor.running_stats(_stream(spark, sf_dir, 8)), "running-stats", "update")
    return sinks.latest_per_key(table, ["level", "service"])


@query("stream_log_lines", f"WITH {oracle.EVENT_LINES} SELECT source, v AS value FROM ev_lines")
def stream_log_lines(spark, sf_dir):
    return _run(_stream(spark, sf_dir, 8), "stream-lines").select("source", "value")


@query("stream_growing_log", f"WITH {oracle.EVENT_LINES} SELECT source, v AS value FROM ev_lines")
def stream_growing_log(spark, sf_dir):
    """Lines of a folder whose logs are followed, stopped, and followed again from the checkpoint after they grew."""
    folder, out = new_shared_path(spark, "growing-logs"), new_shared_path(spark, "followed")
    for part in (0, 1):
        inputs.land_event_files(spark, sf_dir, folder, F.col("event_id") % 2 == part)
        lines = follow.follow_log_lines(spark, folder, "part-*", F.regexp_extract("segment", "source=([^/]+)/", 1))
        sinks.start(lines, f"{out}/table", f"{out}/checkpoint", available_now=True).awaitTermination()
    return sinks.read_batches(spark, f"{out}/table").select("source", "value")


@query("stream_batch_alerts", LOGS + _alert_sql("source"))
def stream_batch_alerts(spark, sf_dir):
    """Alerts of a poll that finds all rows."""
    table = _run(_stream(spark, sf_dir), "batch-alerts", transform=monitor.batch_alerts())
    return table.drop("batch_id").withColumn("rate", _six("rate"))


@query("event_time_alerts", f"""WITH {oracle.EVENT_LOGS.replace('logs AS', 'all_logs AS')},
logs AS (SELECT *, time_bucket(INTERVAL '6 hours', ts) AS interval_start FROM all_logs
         QUALIFY time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' <= max(ts) OVER () - INTERVAL '5 minutes')
""" + _alert_sql("interval_start"))
def event_time_alerts(spark, sf_dir):
    """Alerts on closed intervals of log time, all logs together."""
    cells = monitor.event_time_cells(_stream(spark, sf_dir), "6 hours", "5 minutes", by=[])
    table = _run(cells, "event-time-alerts", transform=monitor.event_time_alerts(by=[]))
    return table.drop("batch_id").withColumn("rate", _six("rate"))


_LAST_100 = """,
tail AS (SELECT * FROM logs QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_ts DESC, event_id DESC) <= 100),
texts AS (SELECT source, count(*) AS analyzed_count, string_agg(raw, chr(10) ORDER BY event_ts, event_id) AS content,
                 arg_min(ts, event_id) AS first_ts, arg_max(ts, event_id) AS last_ts FROM tail GROUP BY source)"""


@query("auto_trigger", f"""
SELECT r.source, r.reason, r.n, t.analyzed_count, r.dropped_count, t.first_ts, t.last_ts, md5(t.content) AS content
FROM ({LOGS}{_auto_sql("source")}) r JOIN ({LOGS}{_LAST_100} SELECT * FROM texts) t USING (source) WHERE r.analyze""")
def auto_trigger(spark, sf_dir):
    """Selections handed out by the automatic trigger when one poll finds all rows."""
    table = _run(triggers.auto_trigger(_stream(spark, sf_dir)), "auto-trigger")
    return table.select("source", "reason", "n", "analyzed_count", "dropped_count", F.col("start").alias("first_ts"),
                        F.col("end").alias("last_ts"), F.md5("text").alias("content"))


@query("recent_buffer", LOGS + f""",
tail AS (SELECT * FROM logs QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_ts DESC, event_id DESC) <= 50),
texts AS (SELECT source, count(*) AS analyzed_count, md5(string_agg(raw, chr(10) ORDER BY event_ts, event_id)) AS content
          FROM tail GROUP BY source),
g AS (SELECT source, count(*) AS n, {_ERR}::BIGINT AS errors, count_if(level = 'CRITICAL')::BIGINT AS criticals
      FROM logs GROUP BY source)
SELECT source, n, errors, criticals, CASE WHEN n >= 20 THEN 'row_count' WHEN errors / n >= 0.1 THEN 'error_rate'
       WHEN criticals >= 5 THEN 'critical_count' ELSE 'first' END AS reason, least(n, 1000) AS buffered, analyzed_count, content
FROM g JOIN texts USING (source)""")
def recent_buffer(spark, sf_dir):
    """Monitor decision, buffer size and rows to analyse when one poll finds all rows."""
    table = _run(triggers.monitor_trigger(_stream(spark, sf_dir)), "recent-buffer")
    return table.select("source", "n", "errors", "criticals", "reason", "buffered", "analyzed_count",
                        F.md5("text").alias("content"))


@query("stream_analyses", f"""
SELECT source, analyzed_count AS log_count, {DETECT} AS analysis_type, md5({_case(DETECT, _CANNED)}) AS analysis,
       strftime(first_ts, '%Y-%m-%dT%H:%M:%S') AS first_ts, strftime(last_ts, '%Y-%m-%dT%H:%M:%S') AS last_ts
FROM ({LOGS}{_LAST_100} SELECT * FROM texts)""")
def stream_analyses(spark, sf_dir):
    """What the automatic trigger hands out, summarised and analysed."""
    table = _run(triggers.auto_trigger(_stream(spark, sf_dir)), "analyses", transform=monitor.analyses())
    return table.select("source", "log_count", "analysis_type", F.md5("analysis").alias("analysis"),
                        F.col("log_time_range.start").alias("first_ts"), F.col("log_time_range.end").alias("last_ts"))


@query("write_reports", f"""
SELECT source, analyzed_count AS log_count, {DETECT} AS analysis_type, 'auto' AS kind, true AS success
FROM ({LOGS}{_LAST_100} SELECT * FROM texts)""")
def write_reports(spark, sf_dir):
    """Analyses of a stream written as JSON reports per micro-batch, and read back as result files."""
    out = new_shared_path(spark, "reports")
    selected = triggers.auto_trigger(_stream(spark, sf_dir)).writeStream.option("checkpointLocation", f"{out}/checkpoint")
    selected.foreachBatch(sinks.write_reports(f"{out}/table", monitor.analyses())).trigger(availableNow=True).start().awaitTermination()
    found = results.read_result_records(spark, f"{out}/table", multi_line=False)
    return found.select("source", "log_count", "analysis_type", "kind", "success")
