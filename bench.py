"""Benchmark: every query of the library and the throughput of its three streams on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion through the `noop` sink (full execution, no
collect): one untimed warm-up run (JIT, file listing), then the best of
`BENCH_REPEATS` timed runs is kept. Streams run over file sources with
`availableNow` and report rows/s. `archive_load` and the archive stream run over
the whole smaller table `$BENCH_ARCHIVE_SF_DIR` (sf0.001), once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = ["city_click_counter", "hourly_uv_hll", "week_begin_offset"]
# This filesystem forks a process per file and folder it creates: the archive is timed over the
# whole of this smaller table (nearly a folder per row already).
ARCHIVE_SF_DIR = os.environ.get("BENCH_ARCHIVE_SF_DIR", os.path.join(os.path.dirname(SF_DIR), "sf0.001"))


def _sf_value(path: str):
    m = re.search(r"sf([0-9.]+)$", path)
    return float(m.group(1)) if m else path


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeats: int = REPEATS) -> float:
    best = None
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def _streams(spark, results: dict) -> None:
    from logtide.session import scratch_path
    from logtide.sources.messages import as_messages, stream_messages
    from logtide.sources.tables import csv_lines, load_table, startup_lines
    from logtide.streaming import jobs

    ev = load_table(spark, SF_DIR, "events")
    n = ev.count()
    sources = {
        "click": as_messages(startup_lines(ev), "app-log", 3),
        "uniques": as_messages(csv_lines(ev), "user-csv", 3),
    }
    paths = {}
    for name, msgs in sources.items():
        paths[name] = scratch_path(spark, f"bench-src-{name}")
        msgs.repartitionByRange(8, "timestamp").write.parquet(paths[name])

    def click():
        q = jobs.click_counter_stream(spark, stream_messages(spark, paths["click"], max_files_per_trigger=2),
                                      scratch_path(spark, "bench-clicks"), trigger="availableNow")
        q.awaitTermination()

    def uniques():
        q = jobs.hourly_uniques_stream(spark, stream_messages(spark, paths["uniques"], max_files_per_trigger=2),
                                       scratch_path(spark, "bench-uv"), trigger="availableNow")
        q.awaitTermination()

    small = load_table(spark, ARCHIVE_SF_DIR, "events")
    paths["archive"] = scratch_path(spark, "bench-src-archive")
    as_messages(startup_lines(small), "app-log", 3).repartitionByRange(8, "timestamp").write.parquet(paths["archive"])

    def archive():
        q = jobs.archive_stream(stream_messages(spark, paths["archive"], max_files_per_trigger=2),
                                scratch_path(spark, "bench-archive"), scratch_path(spark, "bench-ckpt"),
                                trigger="availableNow")
        q.awaitTermination()

    for name, fn, rows, repeats in (("click_stream", click, n, REPEATS), ("uniques_stream", uniques, n, REPEATS),
                                    ("archive_stream", archive, small.count(), 1)):
        sec = _time(fn, repeats)
        results[f"{name}_sec"] = sec
        results[f"{name}_rows_per_sec"] = round(rows / sec, 1)


def main() -> None:
    from logtide.session import local_session
    from logtide.plans import catalog

    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS) * 2 if CPUS.isdigit() else 16,
                          app="logtide-bench", conf={"spark.driver.memory": "12g"})
    qs = catalog.queries()
    results: dict[str, float] = {}
    for name in HEADLINE + [q for q in qs if q not in HEADLINE]:
        if name == "archive_load":
            results[name] = _time(lambda: _run(qs["archive_load"](spark, ARCHIVE_SF_DIR)), 1)
            continue
        _run(qs[name](spark, SF_DIR))                 # untimed warm-up run
        results[name] = _time(lambda name=name: _run(qs[name](spark, SF_DIR)))
    if os.environ.get("BENCH_STREAMS", "1") == "1":
        _streams(spark, results)
    total = round(sum(results[q] for q in HEADLINE), 3)
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": results, "sf": _sf_value(SF_DIR), "cpus": CPUS,
                      "headline": HEADLINE, "archive_sf": _sf_value(ARCHIVE_SF_DIR)}))


if __name__ == "__main__":
    main()
