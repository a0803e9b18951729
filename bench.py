"""Headline queries, timed.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
Every query runs whole, into a sink that discards the rows; the time is the median of BENCH_RUNS (3) after
one run that is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logweft.plans.catalog import QUERIES  # noqa: E402
from logweft.session import build_session  # noqa: E402

HEADLINE = [
    "window_types", "text_windows", "token_windows", "token_windows_long_sources", "conversation_windows",
    "merge_windows", "split_large_lines", "request_payload", "analyze_windows", "parse_log", "level_and_service_counts",
    "log_summary", "recent_logs", "hourly_alerts", "auto_trigger_batch", "read_log_lines", "running_stats", "auto_trigger",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("logweft-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    print(json.dumps({
        "metric": "headline query seconds", "value": round(sum(seconds.values()), 4), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)),
    }))


if __name__ == "__main__":
    main()
