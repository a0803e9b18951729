"""Prompt texts, request bodies and answers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweft.fixed_values import MODEL_NAME, SELECTION_SYSTEM_PROMPT, SELECTION_USER_PREFIX, UNKNOWN
from logweft.functions.classify import DEFAULT_TYPES, AnalysisTypes, analysis_config, system_prompt, task_block

META_FIELDS = ["service", "host", "severity", "time_range"]

# Answers of the canned scorer: our own texts, one for each of two types and one for all others.
CANNED_ANSWERS = {
    "database": (
        "Findings: connections to the database time out and the pool runs empty.\n"
        "Likely cause: slow statements hold connections; missing index; network delay.\n"
        "Check: list active sessions and open sockets of the database port.\n"
        "Next: enlarge the pool, tune the statements, watch connection counts.\n"
        "Confidence: medium"
    ),
    "memory": (
        "Findings: memory use climbs until allocation fails; collector pressure rises.\n"
        "Likely cause: a leak; large objects; too little memory on the host.\n"
        "Check: free memory, largest processes, a heap dump.\n"
        "Next: fix the leak, size the heap, alert on memory use.\n"
        "Confidence: high"
    ),
    "general": (
        "Findings: connection failures, rising memory use, workers down, service lost.\n"
        "Likely cause: exhausted connections; a memory leak; too few resources.\n"
        "Check: sockets, memory, service journal.\n"
        "Next: adjust pools, alert on memory, restart policy, resource limits.\n"
        "Confidence: medium"
    ),
}


def meta_defaults(meta: dict[str, Column]) -> dict[str, Column]:
    """The four fields of a prompt's header; a missing one reads ``[unknown]``."""
    return {
        name: F.coalesce(meta.get(name, F.lit(None)).cast("string"), F.lit(UNKNOWN)) for name in META_FIELDS}


def processed_at(run_ts: str | Column) -> Column:
    """Time range of a run whose logs carry none."""
    return F.concat(F.lit("processed_at="), F.lit(run_ts) if isinstance(run_ts, str) else run_ts, F.lit("Z"))


def user_prompt(kind: Column, meta: dict[str, Column], content: Column, types: AnalysisTypes = DEFAULT_TYPES) -> Column:
    """Header with meta, the log content verbatim, and the task block of the type."""
    field = meta_defaults(meta)
    return F.concat(
        F.lit("[META]\nservice="), field["service"],
        F.lit("\nhost="), field["host"],
        F.lit("\ntime_range="), field["time_range"],
        F.lit("\nseverity_top="), field["severity"],
        F.lit("\n\n[LOG WINDOW]\n"), content,
        F.lit("\n\n"), task_block(kind, types),
    )


def _chat(system: Column, user: Column, temperature: Column, max_tokens: Column, model: str) -> Column:
    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.to_json(F.struct(
        F.lit(model).alias("model"),
        F.array(turn("system", system), turn("user", user)).alias("messages"),
        temperature.alias("temperature"),
        max_tokens.alias("max_tokens"),
    ))


def request_payload(kind: Column, prompt: Column, types: AnalysisTypes = DEFAULT_TYPES, model: str = MODEL_NAME) -> Column:
    """JSON body of a chat request for one window."""
    config = analysis_config(kind, types)
    return _chat(system_prompt(kind, types), prompt, config["temperature"], config["max_tokens"], model)


def selection_payload(text: Column, model: str = MODEL_NAME) -> Column:
    """JSON body that asks about a whole selection of rows with one prompt."""
    return _chat(F.lit(SELECTION_SYSTEM_PROMPT), F.concat(F.lit(SELECTION_USER_PREFIX), text),
                 F.lit(0.2), F.lit(1200), model)


def response_text(response: Column) -> Column:
    """Answer text of a chat response."""
    return F.get_json_object(response, "$.choices[0].message.content")


def canned_analysis(kind: Column) -> Column:
    """Fixed answer by type, for runs without a model."""
    return (
        F.when(kind == "database", F.lit(CANNED_ANSWERS["database"]))
        .when(kind == "memory", F.lit(CANNED_ANSWERS["memory"]))
        .otherwise(F.lit(CANNED_ANSWERS["general"]))
    )
