import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweft.config import AutoThresholds, MonitorThresholds
from logweft.fixed_values import LEVELS, SERVICES
from logweft.functions.display import time_ago
from logweft.operators import aggregates as agg
from logweft.operators import alerts as al
from logweft.operators import reports


def logs(spark, pairs, source="s"):
    start = dt.datetime(2024, 1, 15, 10, 30)
    rows = [(source, i, start + dt.timedelta(seconds=i), level, service) for i, (level, service) in enumerate(pairs)]
    return spark.createDataFrame(
        rows, "source string, line_no long, ts timestamp_ntz, level string, service string").repartition(3)


# Level and service per line of sample logs (first letters of the levels).
NAMES = dict(zip("DIWEC", LEVELS))
SAMPLE_A = [(NAMES[x], "ordersvc") for x in "EWEWEEIWECIIII"]
SAMPLE_B = [(NAMES[x], s) for x, s in zip("EWIECIWEI", ["ordersvc", "paymentsvc", "usersvc", "ordersvc", "ordersvc", "ordersvc", "inventorysvc", "ordersvc", "ordersvc"])]
SAMPLE_L = [(NAMES["EWI"[i % 3]], "ordersvc") for i in range(100)]
SAMPLE_R = [(NAMES[p[0]], p[2:]) for p in (
    "D:paymentsvc W:worker E:analyticsvc I:ordersvc W:websocket I:notificationsvc I:gateway I:paymentsvc I:scheduler "
    "I:scheduler W:analyticsvc C:inventorysvc W:ordersvc I:authsvc W:usersvc D:authsvc I:usersvc I:paymentsvc I:websocket "
    "W:gateway I:websocket I:scheduler I:usersvc E:paymentsvc I:scheduler I:notificationsvc").split()]


def pairs_of(rows):
    return {r[0]: r[1] for r in rows.collect()}


def test_counts_of_a_sample(spark):
    sample = logs(spark, SAMPLE_R)
    assert pairs_of(agg.level_counts(sample)) == {"DEBUG": 2, "INFO": 15, "WARN": 6, "ERROR": 2, "CRITICAL": 1}
    assert pairs_of(agg.zero_filled_counts(sample, "service")) == dict(zip(SERVICES, [2, 4, 3, 1, 2, 2, 2, 2, 0, 3, 4, 1]))
    assert pairs_of(agg.zero_filled_counts(logs(spark, SAMPLE_A), "level")) == {
        "DEBUG": 0, "INFO": 5, "WARN": 3, "ERROR": 5, "CRITICAL": 1}
    assert [tuple(r) for r in agg.top_services(sample).collect()] == [("paymentsvc", 4), ("scheduler", 4), ("usersvc", 3)]
    assert tuple(agg.error_counts(sample).first()) == (2, 1)
    assert agg.error_rate(sample).first().error_rate == 3 / 26
    assert {r.level: round(r.percent, 1) for r in agg.level_percent(sample).collect()}["INFO"] == 57.7
    both = {(r.dimension, r.key): r.n for r in agg.level_and_service_counts(sample).collect()}
    assert both["total", "all"] == 26 and both["level", "WARN"] == 6 and both["service", "worker"] == 1
    assert len(both) == 1 + 5 + 11


def test_no_rows(spark):
    none = logs(spark, SAMPLE_A).filter("false")
    assert agg.error_rate(none).first().error_rate == 0.0
    assert agg.throughput(none).first().per_second == 0.0
    assert al.alerts(none).count() == 0
    assert al.level_totals(none).first().n == 0
    assert not al.auto_trigger_batch(none, []).first().analyze
    assert tuple(reports.analysis_totals(none.selectExpr("true AS success", "1 AS log_count")).first()) == (0, 0, 0, 0, 0.0)


def test_summary(spark):
    row = agg.log_summary(logs(spark, SAMPLE_B)).first()
    assert row.total == 9
    assert row.by_level == Counter(x for x, _ in SAMPLE_B)
    assert row.by_service == Counter(s for _, s in SAMPLE_B)
    assert (str(row.start), str(row.end)) == ("2024-01-15 10:30:00", "2024-01-15 10:30:08")


def test_summary_times_follow_arrival(spark):
    late_first = logs(spark, SAMPLE_B).withColumn("line_no", 100 - F.col("line_no"))
    row = agg.log_summary(late_first).first()
    assert (str(row.start), str(row.end)) == ("2024-01-15 10:30:08", "2024-01-15 10:30:00")


def test_throughput_does_not_depend_on_the_zone(spark, conf):
    conf("spark.sql.session.timeZone", "Europe/Berlin")
    day = spark.sql("SELECT explode(array(TIMESTAMP_NTZ'2024-03-31 01:00:00', TIMESTAMP_NTZ'2024-03-31 05:00:00')) AS ts")
    assert agg.throughput(day).first().per_second == 2 / 14400
    ago = time_ago(F.col("ts"), F.lit("2024-03-31 05:30:00").cast("timestamp_ntz"))
    assert sorted(r[0] for r in day.select(ago).collect()) == ["30분 전", "4.5시간 전"]


def test_tail(spark):
    values = ["2024-01-15 10:30:15 ERROR [s] x"] * 10 + ["no log line"] * 3 + ["2024-01-15 10:30:15 CRITICAL [s] x"] * 2
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(values)], "source string, line_no long, value string")
    row = agg.tail_level_stats(lines, 7).first()
    assert (row.total_lines, row.parsed_lines, row.error, row.critical, row.error_count, row.critical_count) == (15, 4, 2, 2, 2, 2)


@pytest.mark.parametrize("sample, kinds, fires", [
    (SAMPLE_A, {("error_rate", None, 6), ("service_errors", "ordersvc", 6)}, None),
    (SAMPLE_B, {("error_rate", None, 4)}, None),
    (SAMPLE_A[:1] + SAMPLE_A[1:2] + SAMPLE_A[-1:], {("error_rate", None, 1)}, None),
    (SAMPLE_L, {("error_rate", None, 34), ("service_errors", "ordersvc", 34)}, "error_rate"),
    (SAMPLE_R, {("error_rate", None, 3)}, None),
])
def test_sample_alerts_and_triggers(spark, sample, kinds, fires):
    found = al.alerts(logs(spark, sample)).collect()
    assert {(r.kind, r.service, r["count"]) for r in found} == kinds
    decision = al.auto_trigger_batch(logs(spark, sample)).first()
    assert decision.reason == fires and decision.analyze == (fires is not None)


def test_alert_text(spark):
    texts = {r[0] for r in al.alerts(logs(spark, SAMPLE_A)).select(al.alert_text()).collect()}
    assert texts == {"🚨 높은 에러율: 42.9%", "🚨 ordersvc 서비스 에러 다수: 6개"}


@pytest.mark.parametrize("counts, reason", [
    (dict(INFO=19), None), (dict(INFO=20), None), (dict(INFO=17, ERROR=3), "error_rate"), (dict(INFO=30, CRITICAL=3), "critical_count"),
    (dict(INFO=30, CRITICAL=2), None), (dict(INFO=20, WARN=10), "warning_count"), (dict(INFO=20, WARN=9), None),
    (dict(INFO=40, ERROR=5), "service_errors"), (dict(INFO=400, ERROR=4), None), (dict(ERROR=19), None)])
def test_auto_rules(spark, counts, reason):
    rows = logs(spark, [(level, "svc") for level, n in counts.items() for _ in range(n)])
    assert al.auto_trigger_batch(rows).first().reason == reason


def test_auto_counts_what_it_drops(spark):
    row = al.auto_trigger_batch(logs(spark, SAMPLE_L * 2)).first()
    assert (row.n, row.analyzed_count, row.dropped_count) == (200, 100, 100)


@pytest.mark.parametrize("counts, since, reason", [
    (dict(INFO=20), 1.0, "row_count"), (dict(INFO=9, ERROR=1), 1.0, "error_rate"), (dict(INFO=19), 1.0, None),
    (dict(INFO=1), None, "first"), (dict(INFO=1), 30.0, "interval"), (dict(INFO=1), 29.9, None)])
def test_monitor_rules(spark, counts, since, reason):
    rows = logs(spark, [(level, "svc") for level, n in counts.items() for _ in range(n)])
    since = None if since is None else F.lit(since)
    row = al.monitor_trigger(rows, ["source"], since).first()
    assert row.reason == reason and row.analyze == (reason is not None)


def test_own_thresholds(spark):
    rows = logs(spark, [("INFO", "s")] * 95 + [("ERROR", "s")] * 5)
    assert al.alerts(rows, thresholds=MonitorThresholds(error_rate=0.05, service_errors=6)).first().kind == "error_rate"
    assert al.auto_trigger_batch(rows, thresholds=AutoThresholds(error_rate=0.05)).first().reason == "error_rate"


def test_random_logs_by_source(spark):
    rng = random.Random(1)
    sources = {f"s{i}": [(rng.choice(LEVELS), f"v{rng.randint(0, 3)}") for _ in range(rng.choice([3, 25, 200]))] for i in range(12)}
    whole = None
    for name, pairs in sources.items():
        part = logs(spark, pairs, name)
        whole = part if whole is None else whole.unionByName(part)
    totals = {r.source: r for r in al.level_totals(whole, ["source"]).collect()}
    found = {(r.source, r.kind, r.service) for r in al.alerts(whole, ["source"]).collect()}
    for name, pairs in sources.items():
        errors = [s for x, s in pairs if x in ("ERROR", "CRITICAL")]
        criticals = sum(x == "CRITICAL" for x, _ in pairs)
        t = totals[name]
        assert (t.n, t.errors, t.criticals, t.warnings) == (
            len(pairs), len(errors), criticals, sum(x == "WARN" for x, _ in pairs))
        assert t.worst_service_errors == max(Counter(errors).values(), default=0)
        expected = {("error_rate", None)} if len(errors) / len(pairs) >= 0.1 else set()
        expected |= {("critical_count", None)} if criticals >= 5 else set()
        expected |= {("service_errors", s) for s, n in Counter(errors).items() if n >= 5}
        assert {(k, s) for n, k, s in found if n == name} == expected


def test_run_and_latency_reports(spark):
    runs = spark.createDataFrame(
        [("mock", True, 2.0), ("mock", True, 4.0), ("mock", False, 99.0), ("model", False, 5.0)],
        "test_type string, success boolean, duration double")
    report = {r.test_type: tuple(r)[1:] for r in reports.run_report(runs, ["test_type"]).collect()}
    assert report["model"] == (1, 0, 1, 0.0, 0.0)
    assert report["mock"][:3] == (3, 2, 1) and report["mock"][4] == 3.0
    assert reports.run_details(runs, True).count() == 2
    assert tuple(reports.latency_summary(runs, 2.0).first()) == (4, 2, 2.0, 3.0, 2.0, 4.0)
    assert tuple(reports.latency_summary(runs.filter("not success"), 1.0).first()) == (2, 0, 2.0, 0.0, 0.0, 0.0)
    assert tuple(reports.run_report(runs.filter("false")).first()) == (0, 0, 0, 0.0, 0.0)
