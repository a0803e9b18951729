"""Building blocks of the SQL that checks the queries."""

from __future__ import annotations

from logweft.fixed_values import NOISE_WORDS, TYPE_KEYWORDS
from logweft.plans.inputs import EVENT_MESSAGES


def text(value: str) -> str:
    """SQL literal."""
    return "'" + value.replace("'", "''") + "'"


DOCUMENT_LINES = """
doc_lines AS (
  SELECT source, (i - 1)::BIGINT AS i, v FROM (
    SELECT doc_id::VARCHAR AS source, unnest(string_split(text, chr(10))) AS v,
           generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents))"""

CONVERSATION_LINES = """
conv_lines AS (SELECT conv_id::VARCHAR AS source, turn::BIGINT AS i, text AS v FROM conversations)"""

_MESSAGE = "CASE event_id % 7 " + " ".join(
    f"WHEN {i} THEN {text(m)}" for i, m in enumerate(EVENT_MESSAGES)) + " END"

EVENT_LINES = f"""
ev_lines AS (
  SELECT 'log' || (user_id % 16) AS source, ts AS event_ts, event_id, event_type,
         strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' ||
         CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'CRITICAL' WHEN event_type = 'error' THEN 'ERROR'
              WHEN event_type = 'signup' THEN 'WARN' WHEN event_type = 'purchase' THEN 'DEBUG' ELSE 'INFO' END
         || ' [svc' || (user_id % 12) || '] ' || {_MESSAGE} AS v
  FROM events)"""

NUMBERED_EVENT_LINES = EVENT_LINES + """,
ev_numbered AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY event_ts, event_id) - 1 AS i, v FROM ev_lines)"""

_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (\w+) \[(\w+)\] (.+)"


def parsed(lines: str, name: str = "logs", keep: str = "source, event_ts, event_id") -> str:
    """CTE of parsed records over a CTE of lines with column v; ``ts`` is null on bad times, ``stamp`` empty on others."""
    field = [f"regexp_extract(raw, '{_PATTERN}', {g})" for g in range(5)]
    return f"""
{name} AS (
  SELECT {keep}, raw, try_cast({field[1]} AS TIMESTAMP) AS ts, {field[2]} AS level, {field[3]} AS service,
         {field[4]} AS message, {field[1]} AS stamp
  FROM (SELECT *, trim(v, chr(9) || chr(10) || chr(13) || ' ') AS raw FROM {lines}))"""


EVENT_LOGS = EVENT_LINES + "," + parsed("ev_lines")
IS_ERROR = "level IN ('ERROR', 'CRITICAL')"


def detect(column: str) -> str:
    """Type detection of a text column."""
    branches = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({column}), {text(w)})" for w in words) + f" THEN {text(name)}"
        for name, words in TYPE_KEYWORDS.items())
    return f"CASE {branches} ELSE 'general' END"


def kept_line(column: str = "v") -> str:
    """Default cleaning predicate."""
    words = " AND ".join(f"NOT contains(lower({column}), {text(w)})" for w in NOISE_WORDS)
    return f"{words} AND regexp_matches({column}, '\\S')"


TOKENS = "greatest(1, length(v) // 4)::BIGINT"


def packing(prefix: str, rows: str, max_tokens: int, keep: int, carries: bool) -> str:
    """CTEs that pack ``rows(source, i, t)``; the last, ``{prefix}_runs(source, w, s, e, tok)``, has the runs."""
    carry = "min(k.i)" if carries else "NULL"
    return f"""
{prefix}_p AS (
  SELECT source, i, t, sum(t) OVER (PARTITION BY source ORDER BY i)::BIGINT AS c,
         count(*) OVER (PARTITION BY source) AS n FROM {rows}),
{prefix}_e AS (
  SELECT s.source, s.i AS s, any_value(s.c - s.t) AS before, any_value(s.n) AS n, max(x.i) AS e, max(x.c) AS ce,
         any_value(s.t) AS own
  FROM {prefix}_p s LEFT JOIN {prefix}_p x
    ON x.source = s.source AND x.i >= s.i AND x.c - (s.c - s.t) <= {max_tokens}
  GROUP BY s.source, s.i),
{prefix}_k AS (
  SELECT e.source, e.s, {carry} AS k, min(k.c - k.t) AS ck
  FROM {prefix}_e e LEFT JOIN {prefix}_p k
    ON k.source = e.source AND k.i >= e.s AND k.i <= e.e AND e.ce - (k.c - k.t) <= {keep}
  GROUP BY e.source, e.s),
{prefix}_n AS (
  SELECT e.source, e.s, coalesce(e.e, e.s) AS e, coalesce(e.ce - e.before, e.own) AS tok, e.n,
         CASE WHEN e.e IS NULL THEN e.s + 1
              WHEN e.e = e.n - 1 THEN e.n
              WHEN k.k IS NULL THEN e.e + 1
              WHEN f.c - k.ck > {max_tokens} THEN e.e + 1
              ELSE k.k END AS nx
  FROM {prefix}_e e JOIN {prefix}_k k USING (source, s)
  LEFT JOIN {prefix}_p f ON f.source = e.source AND f.i = e.e + 1),
{prefix}_chain AS (
  SELECT source, s, e, tok, n, nx, 0 AS w FROM {prefix}_n WHERE s = 0
  UNION ALL
  SELECT x.source, x.s, x.e, x.tok, x.n, x.nx, c.w + 1
  FROM {prefix}_chain c JOIN {prefix}_n x ON x.source = c.source AND x.s = c.nx WHERE c.nx < c.n),
{prefix}_runs AS (SELECT source, w, s, e, tok::BIGINT AS tok FROM {prefix}_chain)"""


def windows(lines: str, max_tokens: int, ratio: float, prefix: str = "win", tokens: str = TOKENS) -> str:
    """CTEs from ``lines(source, i, v)`` to ``{prefix}`` with the window columns."""
    keep = int(max_tokens * ratio) if ratio > 0 else 0
    return f"""
{prefix}_t AS (SELECT source, i, {tokens} AS t FROM {lines}),{packing(prefix, f"{prefix}_t", max_tokens, keep, ratio > 0)},
{prefix} AS (
  SELECT r.source, r.w::INTEGER AS window_index,
         (count(*) OVER (PARTITION BY r.source))::INTEGER AS total_windows,
         r.s::BIGINT AS start_line, r.e::BIGINT AS end_line, any_value(r.tok) AS token_count,
         string_agg(l.v, chr(10) ORDER BY l.i) AS content
  FROM {prefix}_runs r JOIN {lines} l ON l.source = r.source AND l.i BETWEEN r.s AND r.e
  GROUP BY r.source, r.w, r.s, r.e)"""


def stats(by: str, from_: str = "win") -> str:
    """Window statistics as a SELECT."""
    return f"""
SELECT {by}, count(*) AS total_windows, sum(token_count)::BIGINT AS total_tokens,
       round(avg(token_count), 6) AS avg_tokens_per_window, min(token_count) AS min_tokens,
       max(token_count) AS max_tokens, sum(end_line - start_line + 1)::BIGINT AS total_lines
FROM {from_} GROUP BY ALL"""
