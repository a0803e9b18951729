import os
import random
from collections import Counter

import pytest

from logweft import jobs
from logweft.config import AutoThresholds, MonitorThresholds
from logweft.sources.streams import stream_log_lines
from logweft.streaming import monitor, sinks, triggers


class Producer:
    """Rolls segments into a folder, and runs a stream over what is there."""

    def __init__(self, spark, path):
        self.spark, self.path, self.segments = spark, path, 0
        os.makedirs(path / "in")

    def roll(self, *logs):
        for name, lines in logs:
            self.segments += 1
            (self.path / "in" / f"{name}.log.20240101_{self.segments:06d}.1").write_text("\n".join(lines) + "\n")

    def lines(self, **options):
        return stream_log_lines(self.spark, str(self.path / "in"), **options)

    def poll(self, frame, name="q", mode="append", transform=None):
        out = str(self.path / name)
        query = sinks.start(frame, f"{out}/table", f"{out}/checkpoint", mode, transform, available_now=True)
        query.awaitTermination(120)
        assert query.exception() is None and not query.isActive
        return sinks.read_batches(self.spark, f"{out}/table")


@pytest.fixture
def producer(spark, tmp_path):
    return Producer(spark, tmp_path)


def line(second, level="INFO", service="svc", text="m"):
    return f"2024-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d} {level} [{service}] {text}"


def some_lines(n, seed=0, start=0):
    rng = random.Random(seed)
    return [line(start + i, rng.choice(["INFO", "WARN", "ERROR", "DEBUG"]), f"v{rng.randint(0, 3)}") for i in range(n)]


def test_running_stats_equal_the_batch(spark, producer):
    everything = []
    for part in range(3):
        lines = some_lines(50, part) + ["noise"]
        everything += lines
        producer.roll(("a", lines))
        table = producer.poll(monitor.running_stats(producer.lines()), mode="update")
    assert table.select("batch_id").distinct().count() == 3
    latest = {(r.level, r.service): r.n for r in sinks.latest_per_key(table, ["level", "service"]).collect()}
    assert latest == Counter((x.split()[2], x.split()[3][1:-1]) for x in everything if x != "noise")


def test_batch_alerts_look_at_one_poll(producer):
    producer.roll(("a", [line(i, "ERROR") for i in range(4)]))
    producer.poll(producer.lines(), transform=monitor.batch_alerts())
    producer.roll(("a", [line(i) for i in range(95)] + [line(99, "CRITICAL") for _ in range(5)]))
    rows = producer.poll(producer.lines(), transform=monitor.batch_alerts()).collect()
    assert {(r.batch_id, r.kind, r["count"]) for r in rows} == {
        (0, "error_rate", 4), (1, "critical_count", 5), (1, "service_errors", 5)}


def test_event_time_alerts_do_not_depend_on_batches(spark, tmp_path):
    lines = some_lines(1800, 5)
    results = []
    for run, parts in enumerate((1, 4)):
        producer = Producer(spark, tmp_path / str(run))
        for p in range(parts):
            producer.roll(("a", lines[p * 1800 // parts:(p + 1) * 1800 // parts]))
            table = producer.poll(monitor.event_time_cells(producer.lines(), "1 minute", "5 minutes"),
                                  transform=monitor.event_time_alerts())
        results.append(sorted(map(str, table.drop("batch_id").collect())))
    assert results[0] == results[1] and results[0]


def test_event_time_does_not_depend_on_the_zone(spark, conf, tmp_path):
    # In Berlin the hour from 02:00 to 03:00 of this day does not exist.
    lines = [f"2024-03-31 {m // 60:02d}:{m % 60:02d}:00 ERROR [svc] m" for m in range(60, 300)]
    results = []
    for zone in ("UTC", "Europe/Berlin", "Asia/Kolkata"):
        conf("spark.sql.session.timeZone", zone)
        producer = Producer(spark, tmp_path / zone.replace("/", "-"))
        producer.roll(("a", lines))
        table = producer.poll(monitor.event_time_cells(producer.lines(), "1 hour", "5 minutes"))
        results.append(sorted((str(r.interval_start), r.n) for r in table.collect()))
    assert results[0] == [(f"2024-03-31 {h:02d}:00:00", 60) for h in (1, 2, 3)]
    assert results[0] == results[1] == results[2]


def auto(producer, **limits):
    return producer.poll(triggers.auto_trigger(producer.lines(), AutoThresholds(**limits)), "auto")


def test_auto_trigger_accumulates_and_starts_anew(producer):
    producer.roll(("a", [line(i, "ERROR", text=f"one {i}") for i in range(12)]), ("b", [line(i) for i in range(300)]))
    assert auto(producer).count() == 0  # too few rows in a, nothing wrong in b
    second = [line(100 + i, text=f"two {i}") for i in range(8)]
    producer.roll(("a", second))
    rows = auto(producer).collect()
    assert [(r.source, r.reason, r.n, r.analyzed_count, r.dropped_count) for r in rows] == [("a.log", "error_rate", 20, 20, 0)]
    assert rows[0].text.split("\n")[-8:] == second
    assert (str(rows[0].start), str(rows[0].end)) == ("2024-01-01 00:00:00", "2024-01-01 00:01:47")
    producer.roll(("a", [line(200 + i, "ERROR") for i in range(19)]))
    assert auto(producer).count() == 1  # counters were cleared
    producer.roll(("a", [line(300)]), ("b", [line(900 + i, "WARN") for i in range(10)]))
    fired = {(r.source, r.reason, r.n, r.analyzed_count, r.dropped_count) for r in auto(producer).collect() if r.batch_id == 3}
    assert fired == {("a.log", "error_rate", 20, 20, 0), ("b.log", "warning_count", 310, 100, 210)}


def test_service_errors_add_up_over_polls(producer):
    for part in range(4):
        producer.roll(("a", [line(part * 100 + i) for i in range(40)] + [line(part * 100 + 99, "ERROR", "bad")]))
        assert auto(producer).count() == 0
    producer.roll(("a", [line(900, "ERROR", "bad")]))
    assert [r.reason for r in auto(producer).collect()] == ["service_errors"]


def test_hot_source_in_many_segments(producer, conf):
    conf("spark.sql.files.maxPartitionBytes", "4k")
    conf("spark.sql.files.openCostInBytes", "1")
    lines = [line(i, "ERROR" if i % 5 == 0 else "INFO", f"v{i % 7}", f"n{i}") for i in range(9000)]
    for part in range(6):
        producer.roll(("hot", lines[part * 1500:(part + 1) * 1500]), (f"cold{part}", [line(part)]))
    rows = auto(producer).collect()
    assert [(r.source, r.n, r.dropped_count) for r in rows] == [("hot.log", 9000, 8900)]
    assert rows[0].text.split("\n") == lines[-100:]


def test_monitor_buffers_and_decides(producer):
    def poll():
        limits = MonitorThresholds(buffer_rows=60, analysis_rows=50, analysis_interval_seconds=3600)
        table = producer.poll(triggers.monitor_trigger(producer.lines(), limits), "monitor")
        return table.orderBy("batch_id").collect()[-1]

    quiet = [line(i, text=f"q{i}") for i in range(15)]
    producer.roll(("a", quiet))
    row = poll()
    assert (row.reason, row.buffered, row.analyzed_count) == ("first", 15, 15)
    producer.roll(("a", [line(100 + i) for i in range(19)]))
    row = poll()
    assert (row.analyze, row.reason, row.buffered, row.text) == (False, None, 34, None)
    busy = [line(200 + i, text=f"b{i}") for i in range(45)]
    producer.roll(("a", busy))
    row = poll()
    assert (row.reason, row.n, row.buffered, row.analyzed_count) == ("row_count", 45, 60, 50)
    assert row.text.split("\n")[-45:] == busy
    producer.roll(("a", [line(400 + i, "CRITICAL" if i == 0 else "INFO") for i in range(10)]))
    assert poll().reason == "error_rate"


def test_analyses_of_a_trigger(producer):
    lines = [line(i, "ERROR", "db1" if i % 2 else "db2", "heap") for i in range(130)]
    producer.roll(("a", lines))
    table = producer.poll(triggers.auto_trigger(producer.lines()), "analyses", transform=monitor.analyses())
    row = table.first()
    assert (row.source, row.log_count, row.window_index, row.analysis_type, row.success) == ("a.log", 100, 0, "database", True)
    assert row.log_summary.by_level == {"ERROR": 100} and row.log_summary.by_service == {"db1": 50, "db2": 50}
    assert (row.log_time_range.start, row.log_time_range.end) == ("2024-01-01T00:00:30", "2024-01-01T00:02:09")


def test_watching_jobs(spark, producer):
    producer.roll(("a", [line(i, "ERROR", "db", "heap") for i in range(30)]), ("b", [line(i) for i in range(3)]))
    out, folder = str(producer.path / "watch"), str(producer.path / "in")
    queries = [*jobs.monitor_logs(spark, folder, out, available_now=True),
               jobs.auto_analyze_logs(spark, folder, out + "-auto", available_now=True)]
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None
    stats = sinks.latest_per_key(sinks.read_batches(spark, out + "/stats"), ["level", "service"])
    assert {(r.level, r.service, r.n) for r in stats.collect()} == {("ERROR", "db", 30), ("INFO", "svc", 3)}
    assert {(r.source, r.kind) for r in sinks.read_batches(spark, out + "/alerts").collect()} == {
        ("a.log", "error_rate"), ("a.log", "service_errors")}
    watched = {(r.source, r.reason, r.log_count, r.analysis_type) for r in sinks.read_batches(spark, out + "/analyses").collect()}
    assert watched == {("a.log", "row_count", 30, "database"), ("b.log", "first", 3, "general")}
    fired = sinks.read_batches(spark, out + "-auto/analyses").collect()
    assert [(r.source, r.reason, r.log_count) for r in fired] == [("a.log", "error_rate", 30)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = sinks.batch_table(str(tmp_path / "t"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert sinks.read_batches(spark, str(tmp_path / "t")).count() == 8


def test_periodic_status(spark, producer):
    seen = []
    listener = monitor.periodic_status(spark, seen.append, seconds=0)
    try:
        producer.roll(("a", some_lines(20)))
        producer.poll(producer.lines())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert any(s["rows"] == 20 for s in seen)
