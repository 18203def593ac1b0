"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Every
query is run to a no-op sink, so all rows and columns are computed and nothing is collected;
the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wattmirror import build_session  # noqa: E402
from wattmirror.checks.registry import load_all  # noqa: E402

HEADLINE = """
vw_01_temperature vw_03_energy vw_04_energy_daily_spring vw_05_energy_billing vw_06_source_status vw_10_sleep_periods
ch_03_bucket_count ch_12_temperature_chart_hour_autumn ch_13_energy_daily_chart cat_03_validate_periods
cat_08_discovery_audit snk_01_upsert_changed snk_02_device_upsert syn_05_backfill syn_07_cadence_decision
syn_15_reconcile fl_01_residual fl_05_allocate_stars fl_05_allocate_shared fl_06_reconcile_sums st_01_transitions
st_04_held_for st_06_suppress_active st_08_asof_state st_16_hold_over_intervals st_17_departures st_23_hourly_stats
st_23_stream_hourly_stats
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    cores = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = build_session(f"local[{cpus}]", "bench", shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()

    def seconds(name: str) -> float:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds("vw_06_source_status")                                  # start the JVM's compilers
    timed = {name: round(min(seconds(name), seconds(name)), 3) for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
                      "queries": timed, "sf": sf_dir.rsplit("sf", 1)[-1].rstrip("/"), "cores": cores,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
