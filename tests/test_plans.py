"""Shapes of physical plans: what is shuffled, scanned and broadcast."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.functions.classify import detect_analysis_type
from logweft.functions.parse import parse_log
from logweft.operators import aggregates, alerts, lines, windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"s{i % 3}", i // 3, f"2024-01-01 00:00:{i % 60:02d} {'ERROR' if i % 4 == 0 else 'INFO'} [v{i % 5}] m", "unused")
            for i in range(600)]
    spark.createDataFrame(rows, "source string, line_no long, value string, other string").write.parquet(path)
    return spark.read.parquet(path)


def test_text_windows_shuffle_nothing(table):
    found = windows.text_windows(table, source="source", text="value").select("source", detect_analysis_type(F.col("content")))
    text = plan(found)
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<source:string,value:string>" in text and "IsNotNull(value)" in text


def test_windows_shuffle_lines_once(table):
    found = windows.token_windows(table, WindowConfig(50, 0.15))
    found.collect()
    text = plan(found)
    with_lines = [x for x in text.split("\n") if "Exchange hashpartitioning" in x and "REPARTITION_BY_COL" in x]
    assert len(with_lines) == 1 and "other" not in text
    # Which chunks need maps is told by one row per chunk: lines are neither sorted for it nor joined with windows.
    joins = [x for x in text.split("\n") if "Join" in x]
    assert joins and all("LeftSemi" in x for x in joins) and "Window" not in text
    found = windows.token_windows(table, WindowConfig(50, 0.15), content=False)
    assert "content" not in found.columns


@pytest.mark.parametrize("query", [
    alerts.alerts, alerts.auto_trigger_batch, aggregates.level_and_service_counts, aggregates.log_summary,
    lambda logs: lines.recent_logs(logs, 5)])
def test_logs_are_scanned_once_without_python(table, query):
    found = query(parse_log(table))
    found.collect()
    text = plan(found)
    assert text.count("FileScan") == 1
    assert "Python" not in text and "Pandas" not in text and "Join" not in text


def test_percentages_count_once(table):
    found = aggregates.level_percent(parse_log(table))
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_counts_use_hash_aggregation(table):
    text = plan(aggregates.log_summary(parse_log(table)))
    assert "SortAggregate" not in text


def test_last_rows_are_limited_before_the_shuffle(table):
    text = plan(lines.recent_logs(parse_log(table), 5))
    assert text.count("WindowGroupLimit") == 4 and "_salt" in text


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The driver finds the package by path; Python workers do not."""
    root = os.path.abspath(os.path.join(os.path.dirname(__file__), ".."))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from logweft.session import build_session
from logweft.operators.windows import token_windows
spark = build_session("x", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
rows = [("s", i, "x" * 40) for i in range(100)]
print("windows", token_windows(spark.createDataFrame(rows, "source string, line_no long, value string")).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "windows 1" in done.stdout, done.stderr[-2000:]
