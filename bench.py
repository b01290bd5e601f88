"""Benchmark: ingestion and reports at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Setup (not timed): the ``events`` table is landed as raw JSON reading files,
and the whole flow runs once on the smallest test scale (``sf0.001``) so that
the timings below measure execution, not JVM start-up, JIT and code
generation.  Timed, each as its own Spark job(s):

* ``ingest_batch``   JSON files -> validated, partitioned warehouse table (B1)
* ``ingest_rerun``   the same files again: idempotent, writes nothing (X1)
* ``ingest_stream``  the same files through the streaming ingestion (R1)
* ``<report>``       every report (A1-A19) over the warehouse table, computed whole
                     into Spark's ``noop`` sink (nothing row-level reaches the driver)
* ``export_all``     the seven BI exports written as CSV files (A14); the
                     aggregates roll up one shared reading summary

Prints one JSON line: {"metric", "value" (sum of timed seconds), "unit",
"queries": {name: seconds}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorlake.operators import reports  # noqa: E402
from sensorlake.plans.exports import export_all  # noqa: E402
from sensorlake.plans.ingest import ingest_batch  # noqa: E402
from sensorlake.session import build_session, scratch_path  # noqa: E402
from sensorlake.sources.events import land_readings, raw_readings  # noqa: E402
from sensorlake.sources.warehouse import read_warehouse  # noqa: E402
from sensorlake.streaming.ingest import start_ingest  # noqa: E402

REPORTS = {
    "temperature_by_machine_day": reports.temperature_by_machine_day,
    "temperature_by_machine": reports.temperature_by_machine,
    "alerts_by_type": reports.alerts_by_type,
    "alerts_by_type_pct": reports.alerts_by_type_pct,
    "vibration_top5": reports.vibration_top5,
    "vibration_top5_all": reports.vibration_top5_all,
    "pressure_hourly": reports.pressure_hourly,
    "pressure_hourly_std": reports.pressure_hourly_std,
    "raw_export": reports.raw_export,
    "stats_by_type": reports.stats_by_type,
    "stats_by_site": reports.stats_by_site,
    "stats_by_machine": reports.stats_by_machine,
    "hourly_trends": reports.hourly_trends,
    "critical_alerts": reports.critical_alerts,
    "dashboard_summary": reports.dashboard_summary,
    "monitor_stats": reports.monitor_stats,
    "latest_readings": reports.latest_readings,
    "warehouse_stats": reports.warehouse_stats,
    "value_summary": reports.value_summary,
}


def run_flow(spark, sf_dir: str, times: dict[str, float]) -> None:
    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    landing = land_readings(raw_readings(spark, sf_dir), scratch_path(spark, "bench-landing"))

    wh = scratch_path(spark, "bench-warehouse")
    timed("ingest_batch", lambda: ingest_batch(spark, landing, wh, multi_line=False))
    timed("ingest_rerun", lambda: ingest_batch(spark, landing, wh, multi_line=False))

    wh_stream = scratch_path(spark, "bench-warehouse-stream")

    def stream():
        q = start_ingest(spark, landing, wh_stream, scratch_path(spark, "bench-ckpt"),
                         available_now=True, multi_line=False, max_files_per_trigger=None)
        q.awaitTermination()

    timed("ingest_stream", stream)

    table = read_warehouse(spark, wh)
    for name, fn in REPORTS.items():
        timed(name, lambda fn=fn: fn(table).write.format("noop").mode("overwrite").save())
    timed("export_all", lambda: export_all(table, scratch_path(spark, "bench-exports")))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(app="sensorlake-bench")

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    run_flow(spark, warm_dir if os.path.isdir(warm_dir) else sf_dir, {})

    times: dict[str, float] = {}
    run_flow(spark, sf_dir, times)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
