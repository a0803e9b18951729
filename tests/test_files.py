import json
import os
import random

import pytest
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.operators.analyze import analyze_windows
from logweft.operators.reports import result_rollup
from logweft.operators.windows import process_log_file
from logweft.sources.files import file_stats, find_logs, read_log_lines
from logweft.sources.results import latest_result, latest_results, read_result_records, read_results, write_results
from tests import folds


def lines_of(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(os.path.basename(r.source), []).append((r.line_no, r.value))
    return {k: [v for _, v in sorted(x)] for k, x in rows.items()}, {k: [n for n, _ in sorted(x)] for k, x in rows.items()}


@pytest.fixture
def logs(tmp_path):
    rng = random.Random(2)
    content = {}
    for name, n in {"a.log": 5000, "b.log": 3, "c.txt": 800, "d.dat": 2}.items():
        content[name] = [f"{name} {i} " + "x" * rng.randint(0, 60) for i in range(n)]
        (tmp_path / name).write_text("\n".join(content[name]) + "\n")
    (tmp_path / "empty.log").write_text("")
    return tmp_path, content


@pytest.mark.parametrize("split", ["128m", "7k", "100k"])
def test_lines_are_numbered_across_splits(spark, conf, logs, split):
    path, content = logs
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "1k")
    values, numbers = lines_of(read_log_lines(spark, str(path), "*.{log,txt}"))
    assert values == {k: v for k, v in content.items() if k != "d.dat"}
    assert all(n == list(range(len(n))) for n in numbers.values())


def test_line_ends_and_bad_bytes(spark, tmp_path):
    (tmp_path / "x.log").write_bytes(b"one\r\ntwo\n\nfo\xffur \xec\xa3\xbc\nmark \xef\xbf\xbd\nlast")
    values, _ = lines_of(read_log_lines(spark, str(tmp_path)))
    assert values["x.log"] == ["one", "two", "", "four 주", "mark \ufffd", "last"]


def test_rolled_segments_are_one_source(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "1k")
    conf("spark.sql.files.openCostInBytes", "1")
    expected = []
    for part in range(5):
        chunk = [f"{part}-{i}" for i in range(300)]
        expected += chunk
        (tmp_path / f"app.log.2024010{part}_000000.1").write_text("\n".join(chunk) + "\n")
    name = F.regexp_replace("_metadata.file_name", r"\.\d{8}_\d{6}\.\d+$", "")
    values, numbers = lines_of(read_log_lines(spark, str(tmp_path), source=name))
    assert values == {"app.log": expected} and numbers["app.log"] == list(range(1500))


def test_process_log_file(spark, logs):
    path, content = logs
    rows = process_log_file(spark, str(path / "a.log"), WindowConfig(200, 0.15), chunk_lines=210).collect()
    mine = sorted((r.window_index, r.start_line, r.end_line, r.token_count) for r in rows)
    expected = folds.windows([max(1, len(x) // 4) for x in content["a.log"]], 200, 0.15)
    assert [x[1:] for x in mine] == expected


def test_find_and_stat(spark, logs):
    path, content = logs
    assert [r.file for r in find_logs(spark, str(path)).collect()] == ["a.log", "b.log", "c.txt", "empty.log"]
    assert [r.file for r in find_logs(spark, str(path), "*.log").collect()] == ["a.log", "b.log", "empty.log"]
    wanted = spark.createDataFrame([("a.log",), ("empty.log",), ("gone.log",)], "file string")
    stats = {r.file: r for r in file_stats(spark, str(path), expected=wanted).collect()}
    assert stats["a.log"].lines == 5000 and stats["a.log"].size == os.path.getsize(path / "a.log")
    assert (stats["empty.log"].lines, stats["empty.log"].size) == (0, 0)
    assert stats["empty.log"].last_modified is not None
    assert (stats["gone.log"].lines, stats["gone.log"].size, stats["gone.log"].last_modified) == (0, 0, None)


def put(path, name, data, when):
    file = path / name
    file.write_text(data if isinstance(data, str) else json.dumps(data, ensure_ascii=False, indent=2))
    os.utime(file, (when, when))


def test_result_files(spark, tmp_path):
    window = {"meta": {"service": "s", "window_index": 0, "total_windows": 2}, "analysis": "first", "analysis_type": "memory"}
    older = {"meta": {"service": "s", "window_index": 0, "total_windows": 1}, "analysis": "old"}
    auto = {"analysis_id": 1, "timestamp": "t", "log_count": 25, "log_time_range": {"start": "a", "end": "b"},
            "log_summary": {"total": 25, "by_level": {"INFO": 25}, "by_service": {"x": 25}}, "analysis": "auto", "success": True}
    put(tmp_path, "analysis_results.json", [{**window, "meta": {**window["meta"], "window_index": 1}, "analysis": "second"}, window], 1000)
    put(tmp_path, "analysis_results_old.json", [older], 2000)
    put(tmp_path, "auto_analysis_1.json", auto, 3000)
    put(tmp_path, "auto_analysis_2.json", {**auto, "success": False}, 4000)
    put(tmp_path, "monitor_analysis_1.json", {"success": True, "timestamp": "t", "log_count": 50, "analysis": "m"}, 5000)
    put(tmp_path, "auto_analysis_stats_1.json", {"total_analyses": 3, "successful_analyses": 3}, 6000)
    put(tmp_path, "analysis_results_bad.json", "{not json", 7000)
    put(tmp_path, "other.json", [window], 8000)
    found = {r.file: r for r in read_results(spark, str(tmp_path)).collect()}
    assert {k: (r.type, r.success, r.analysis) for k, r in found.items()} == {
        "analysis_results.json": ("pipeline", True, "first"),
        "analysis_results_old.json": ("pipeline", True, "old"),
        "auto_analysis_1.json": ("auto", True, "auto"),
        "auto_analysis_2.json": ("auto", False, "auto"),
        "monitor_analysis_1.json": ("auto", True, "m"),
        "auto_analysis_stats_1.json": ("unknown", False, None),
        "analysis_results_bad.json": ("unknown", False, None),
        "other.json": ("pipeline", True, "first"),
    }
    assert found["auto_analysis_1.json"].log_summary.by_level == {"INFO": 25}
    results = read_results(spark, str(tmp_path))
    assert [r.file for r in latest_results(results, 3).collect()] == [
        "monitor_analysis_1.json", "auto_analysis_2.json", "auto_analysis_1.json"]
    assert latest_results(results).count() == 5
    assert latest_result(results).first().file == "other.json"
    rollup = {r.file: tuple(r)[1:] for r in result_rollup(read_result_records(spark, str(tmp_path))).collect()}
    assert rollup["analysis_results.json"] == (2, 11, True)
    assert rollup["auto_analysis_stats_1.json"] == (1, 0, False)


def test_rollup_of_files_of_one_name(spark, tmp_path):
    """Tasks of one write give files of the same name to several folders."""
    for folder, texts in (("a", ["one", "two"]), ("b", ["three"])):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder, "part-0.json", [{"analysis": t} for t in texts], 1000 if folder == "a" else 2000)
    records = read_result_records(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    rollup = {r.path.split("/")[-2]: tuple(r)[1:] for r in result_rollup(records, ["path"]).collect()}
    assert rollup == {"a": (2, 6, True), "b": (1, 5, True)}
    assert result_rollup(records).first().windows == 3
    newest = latest_result(read_results(spark, [str(tmp_path / "a"), str(tmp_path / "b")])).first()
    assert newest.path.endswith("/b/part-0.json")


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_written_results(spark, tmp_path, fmt):
    windows = spark.createDataFrame(
        [("s", i, 3, 0, 1, 5, c) for i, c in enumerate(["sql", "heap", "x"])],
        "source string, window_index int, total_windows int, start_line long, end_line long, token_count long, content string")
    records = analyze_windows(windows, run_ts="t")
    out = str(tmp_path / "out")
    write_results(records, out, fmt)
    back = spark.read.format(fmt).load(out)
    assert {(r.analysis_type, r.analysis) for r in back.collect()} == {(r.analysis_type, r.analysis) for r in records.collect()}
    if fmt == "json":
        assert read_result_records(spark, out).filter("kind = 'pipeline'").count() == 3


def test_filtered_lines_are_whole(spark, tmp_path, conf):
    """A filter on the source neither drops lines nor renumbers them, however small the splits are."""
    conf("spark.sql.files.maxPartitionBytes", "20000")
    conf("spark.sql.files.openCostInBytes", "1000")
    for k in range(5):
        (tmp_path / f"f{k}.log").write_text("".join(f"{k} line {i} {'x' * (i % 37)}\n" for i in range(2000)))
    lines = read_log_lines(spark, str(tmp_path))
    source = next(r.source for r in lines.select("source").distinct().collect() if r.source.endswith("f3.log"))
    one = lines.where(lines.source == source)
    assert one.count() == 2000
    assert sorted((r.line_no, r.value.split()[2]) for r in one.collect()) == [(i, str(i)) for i in range(2000)]
    assert lines.where(lines.source.endswith("f1.log")).groupBy("source").count().first()["count"] == 2000


def test_results_in_the_form_they_have(spark, tmp_path):
    """Many records a file, arrays, pretty-printed values and files without a record, all by default."""
    lines = [{"meta": {"service": "s", "window_index": i, "total_windows": 50}, "analysis": f"a{i}"} for i in range(50)]
    put(tmp_path, "lines.json", "\n".join(json.dumps(r) for r in [*lines[:25], *lines[25:]]) + "\n{broken\n", 1000)
    put(tmp_path, "array.json", "[\n" + ",\n".join(json.dumps(r) for r in lines[:3]) + "\n]", 2000)
    put(tmp_path, "pretty.json", json.dumps(lines[0], indent=2), 3000)
    put(tmp_path, "none.json", "[]", 4000)
    records = read_result_records(spark, str(tmp_path))
    counts = {(r.file, r.kind): r["count"] for r in records.groupBy("file", "kind").count().collect()}
    assert counts == {("lines.json", "pipeline"): 50, ("lines.json", "unknown"): 1, ("array.json", "pipeline"): 3,
                      ("pretty.json", "pipeline"): 1}
    found = {r.file: (r.type, r.success, r.analysis) for r in read_results(spark, str(tmp_path)).collect()}
    assert found["none.json"] == ("unknown", False, None)
    assert found["array.json"] == found["pretty.json"] == ("pipeline", True, "a0")


def test_read_results_query_returns_every_record(spark, tmp_path):
    import __spark_entry__ as driver

    rows = [(i, "\n".join(f"{topic} of line {j} " + "y" * 90 for j in range(60))) for i, topic in enumerate(["memory", "harmless", "memory"])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = driver.queries()["read_results"](spark, str(tmp_path)).collect()
    windows = [(r.source, r.window_index) for r in driver.queries()["write_results"](spark, str(tmp_path)).collect()]
    assert len(windows) > 12 and sorted((r.source, r.window_index) for r in found) == sorted(windows)
    assert all((r.kind, r.type, r.success, r.sized, r.first_window) == ("pipeline", "pipeline", True, True, 0) for r in found)
    assert {r.analysis_type for r in found} == {"memory", "general"} and all(r.analysis == r.file_analysis for r in found)
