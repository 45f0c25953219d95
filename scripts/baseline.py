"""Our own baseline figures: parse and stream throughput, and what the stores hold.

    python scripts/baseline.py [sf_dir] [cores]

Prints one JSON line.  Parsing is timed over wire JSON written beforehand
(``noop`` sink, median of 3 after a warm-up); the streams read ten files with
``availableNow`` and rates come from their progress reports.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.functions.codec import parse_events  # noqa: E402
from daybook.schema import KAFKA_SCHEMA  # noqa: E402
from daybook.session import build_session, list_files, list_partitions, run_dir  # noqa: E402
from daybook.sinks.daily import DailyIncrements  # noqa: E402
from daybook.sinks.totals import DailyTotals  # noqa: E402
from daybook.sinks.visitors import SeenVisitors  # noqa: E402
from daybook.sources import fixtures  # noqa: E402
from daybook.streaming import state, stream  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session(f"local[{cores}]", shuffle_partitions=cores)
    base = run_dir(spark, "baseline")
    rows = fixtures.kafka_events(fixtures.load_events(spark, sf_dir)).select(*KAFKA_SCHEMA.fieldNames())
    rows.repartition(10).write.parquet(f"{base}/src")
    raw = spark.read.parquet(f"{base}/src").withColumnRenamed("timestamp", "ingest_ts")
    n = raw.count()
    times = []
    for _ in range(4):
        t0 = time.perf_counter()
        parse_events(raw).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    out = {"rows": n, "cores": cores, "parse_rows_per_s": round(n / statistics.median(times[1:]))}
    seen, pv, uv = SeenVisitors(spark, f"{base}/seen"), DailyIncrements(spark, f"{base}/pv"), DailyIncrements(spark, f"{base}/uv")
    src = stream.kafka_file_stream(spark, f"{base}/src")
    jobs = {"pv": lambda: stream.start_pv_query(src, pv, f"{base}/ck_pv", stream.NOW),
            "uv": lambda: stream.start_uv_query(src, seen, uv, f"{base}/ck_uv", stream.NOW),
            "pv_state": lambda: state.start_pv_state_query(src, DailyTotals(spark, f"{base}/pv_state"), f"{base}/ck_pv_state", stream.NOW),
            "uv_state": lambda: state.start_uv_state_query(
                src, SeenVisitors(spark, f"{base}/seen_state"), DailyIncrements(spark, f"{base}/uv_state"),
                state.StateDays(spark, f"{base}/days"), f"{base}/ck_uv_state", stream.NOW),
            "event_job": lambda: stream.start_event_job(src, stream.EventOutputs(spark, f"{base}/job"), f"{base}/ck", stream.NOW)}
    for name, start in jobs.items():
        p = [x for x in stream.drain(start()).recentProgress if x["numInputRows"]]
        secs = sum(x["durationMs"]["triggerExecution"] for x in p) / 1000
        out[name] = {"batches": len(p), "rows_per_s": round(n / secs), "batch_s": round(secs / len(p), 2)}
    days = list_partitions(spark, f"{base}/seen", "dt")
    files = [f for d in days for f in list_files(spark, f"{base}/seen/dt={d}")]
    jvm = spark.sparkContext._jvm
    size = sum(jvm.java.io.File(f.split(":", 1)[-1]).length() for f in files)
    out["seen_store"] = {"rows": seen.read().count(), "files": len(files), "bytes": int(size)}
    out["increments"] = {"pv_rows": pv.read().count(), "uv_rows": uv.read().count()}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
