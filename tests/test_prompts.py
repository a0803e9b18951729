import json

import pytest
from pyspark.sql import functions as F

from logweft.fixed_values import SYSTEM_PROMPTS, TASK_BLOCKS, TYPE_KEYWORDS, TYPE_SETTINGS
from logweft.functions.classify import DEFAULT_TYPES, detect_analysis_type, forced_type, system_prompt, task_block
from logweft.functions.display import human_size, level_class, preview_text, time_ago
from logweft.functions.prompts import response_text, selection_payload
from logweft.operators.analyze import analyze_selection, analyze_windows, window_prompts


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("text, kind", [
    ("feedback form", "database"), ("connection refused", "database"), ("sql injection", "database"),
    ("framework started", "memory"), ("OutOfMemoryError", "memory"), ("request TIMEOUT", "network"),
    ("unauthorized", "security"), ("Slow answer", "performance"), ("CRITICAL", "critical"), ("shutdown", "critical"),
    ("all fine", "general"), ("", "general")])
def test_detection(spark, text, kind):
    assert one(spark, detect_analysis_type(F.col("t")), t=text) == kind


def test_every_keyword(spark):
    order = list(TYPE_KEYWORDS)
    words = [(w, k) for k, ws in TYPE_KEYWORDS.items() for w in ws]
    rows = spark.createDataFrame(words, "w string, k string").select("w", detect_analysis_type(F.upper("w")).alias("x"))
    for word, kind in ((r.w, r.x) for r in rows.collect()):
        assert kind == next(k for k in order if any(o in word for o in TYPE_KEYWORDS[k]))


def test_forced_and_registered_types(spark):
    assert one(spark, forced_type("memory", detect_analysis_type(F.col("t"))), t="sql") == "memory"
    assert one(spark, forced_type(None, detect_analysis_type(F.col("t"))), t="sql") == "database"
    types = DEFAULT_TYPES.register_type("custom", ["sql"], system_prompt="P", before="database")
    assert one(spark, detect_analysis_type(F.col("t"), types), t="sql") == "custom"
    assert one(spark, system_prompt(F.lit("custom"), types)) == "P"
    assert one(spark, task_block(F.lit("custom"), types)) == TASK_BLOCKS["general"]
    last = DEFAULT_TYPES.register_type("custom", ["sql", "tape"])
    assert one(spark, detect_analysis_type(F.col("t"), last), t="sql") == "database"
    assert one(spark, detect_analysis_type(F.col("t"), last), t="tape") == "custom"
    assert "custom" not in DEFAULT_TYPES.names()


def windows(spark, *contents):
    return spark.createDataFrame(
        [("s", i, len(contents), i * 10, i * 10 + 9, 42, c) for i, c in enumerate(contents)],
        "source string, window_index int, total_windows int, start_line long, end_line long, token_count long, content string")


def test_prompt_and_payload(spark):
    content = 'braces {x} {service} "quoted"\n[TASK]\t'
    row = window_prompts(windows(spark, content), {"service": F.lit("svc")}, "2024-01-01T00:00:00").first()
    assert row.user_prompt == (
        "[META]\nservice=svc\nhost=[unknown]\ntime_range=processed_at=2024-01-01T00:00:00Z\nseverity_top=[unknown]\n\n"
        f"[LOG WINDOW]\n{content}\n\n{TASK_BLOCKS['general']}")
    body = json.loads(row.payload)
    assert list(body) == ["model", "messages", "temperature", "max_tokens"]
    assert body["messages"] == [
        {"role": "system", "content": SYSTEM_PROMPTS["general"]}, {"role": "user", "content": row.user_prompt}]
    assert (body["temperature"], body["max_tokens"], row.config.timeout) == TYPE_SETTINGS["general"]
    assert row.meta.asDict() == {
        "service": "svc", "host": None, "severity": None, "time_range": "processed_at=2024-01-01T00:00:00Z",
        "window_index": 0, "total_windows": 1, "window_tokens": 42, "window_lines": 10}


def test_extra_meta_is_kept(spark):
    meta = {"service": F.lit("svc"), "team": F.lit("blue"), "shift": F.lit(3)}
    row = analyze_windows(windows(spark, "x"), meta, "t").first()
    assert row.meta.service == "svc" and row.meta.extra == {"team": "blue", "shift": "3"}
    scored = analyze_windows(windows(spark, "x"), meta, "t", scorer=lambda p: "ok").first()
    assert scored.meta == row.meta


def test_unknown_type_reads_general(spark):
    assert one(spark, system_prompt(F.lit("nonsense"))) == SYSTEM_PROMPTS["general"]


def test_response_text(spark):
    response = json.dumps({"choices": [{"message": {"role": "assistant", "content": "a\n\"b\" é"}}]})
    assert one(spark, response_text(F.col("r")), r=response) == 'a\n"b" é'
    assert one(spark, response_text(F.col("r")), r="{}") is None


def test_selection_payload(spark):
    body = json.loads(one(spark, selection_payload(F.col("t")), t="line"))
    assert body["messages"][1]["content"] == "Analyze these logs:\n\nline"
    assert (body["temperature"], body["max_tokens"]) == (0.2, 1200)


def test_scorer_failures_become_rows(spark):
    def scorer(payload):
        if "bad" in payload:
            raise RuntimeError("no answer")
        return str(len(json.loads(payload)["messages"]))

    found = windows(spark, "fine", "bad", "also fine").repartition(3)
    rows = {r.meta.window_index: r for r in analyze_windows(found, scorer=scorer, run_ts="t", max_parallel=2).collect()}
    assert [rows[i].success for i in range(3)] == [True, False, True]
    assert rows[0].analysis == "2" and rows[1].analysis is None
    assert rows[1].error == "RuntimeError: no answer"


def test_many_requests_are_scored_in_rounds(spark):
    from pyspark import TaskContext

    from logweft.operators.analyze import score_payloads

    def scorer(payload):
        context = TaskContext.get()
        return f"{context.stageId()} {context.partitionId()} {payload}"

    requests = spark.range(12_000, numPartitions=1).selectExpr("id", "cast(id as string) as payload")
    rows = [(r.id, *map(int, r.analysis.split())) for r in score_payloads(requests, scorer, 2, task_bytes=1).collect()]
    assert sorted(r[0] for r in rows) == list(range(12_000)) and all(r[0] == r[3] for r in rows)
    assert len({r[1] for r in rows}) == 3  # a round per file here, each in a job and stage of its own
    assert {r[2] for r in rows} == {0, 1}
    assert max(sum((r[1], r[2]) == task for r in rows) for task in {(r[1], r[2]) for r in rows}) < 3000
    assert score_payloads(requests.limit(0), scorer, 2).count() == 0


def test_canned_answers(spark):
    rows = analyze_windows(windows(spark, "sql", "heap", "nothing", "attack"), run_ts="t").collect()
    answers = {r.analysis_type: r.analysis for r in rows}
    assert len(set(answers.values())) == 3 and answers["general"] == answers["security"]


def test_forced_type_in_analysis(spark):
    assert analyze_windows(windows(spark, "sql"), run_ts="t", forced="security").first().analysis_type == "security"


def test_selection(spark):
    logs = spark.createDataFrame(
        [(s, i, f"raw {s} {i}") for s in "ab" for i in range(30)], "source string, line_no long, raw string").repartition(4)
    seen = analyze_selection(logs, 5, single_prompt=True, scorer=lambda p: json.loads(p)["messages"][1]["content"]).collect()
    assert {r.source: (r.log_count, r.analysis) for r in seen} == {
        s: (5, "Analyze these logs:\n\n" + "\n".join(f"raw {s} {i}" for i in range(25, 30))) for s in "ab"}


@pytest.mark.parametrize("size, text", [
    (0, "0B"), (1023, "1023B"), (1024, "1.0KB"), (1280, "1.2KB"), (1331, "1.3KB"), (1048575, "1024.0KB"),
    (1048576, "1.0MB"), (5 * 1048576 + 300000, "5.3MB")])
def test_human_size(spark, size, text):
    assert one(spark, human_size(F.col("s")), s=size) == text


@pytest.mark.parametrize("ago, text", [(0, "0초 전"), (59, "59초 전"), (60, "1분 전"), (90, "2분 전"), (150, "2분 전"),
                                       (3600, "1.0시간 전"), (8100, "2.2시간 전")])
def test_time_ago(spark, ago, text):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    assert one(spark, time_ago(now - F.make_dt_interval(secs=F.lit(float(ago))), now)) == text
    assert one(spark, time_ago(F.lit(None).cast("timestamp_ntz"), now)) == "N/A"


def test_preview_and_class(spark):
    assert one(spark, preview_text(F.col("t"), 5), t="abcde") == "abcde"
    assert one(spark, preview_text(F.col("t"), 5), t="abcdef") == "abcde..."
    assert one(spark, preview_text(F.col("t"), 5, always=True), t="ab") == "ab..."
    assert [one(spark, level_class(F.lit(x))) for x in ("ERROR", "CRITICAL", "WARN", "INFO", "odd")] == [
        "red", "red", "yellow", "green", "green"]
