"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the local cores;
``BENCH_REPEATS`` the timed runs per query, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rosterloom.registry import all_queries  # noqa: E402
from rosterloom.session import build_session  # noqa: E402

HEADLINE = (
    "c2_daily_attendance_detail", "c3_employee_summary", "c4_payroll_analytics",
    "c7_staffing_by_shift", "c8_workforce_demographics", "d1_attendance_daily_metrics",
    "d2_attendance_metrics", "d5_executive_alerts", "d6_executive_kpis",
    "d8_monthly_payroll_metrics", "d9_payroll_period_metrics", "d11_workforce_metrics",
    "e2_attendance_trend", "e17_attendance_records", "h3_clinical_staff", "h7_shift_coverage",
    "h9_staffing_ratios",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session("bench", f"local[{cpus}]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{directory}/lineitem.parquet").count()
    queries, seconds = all_queries(), {}
    wanted = sys.argv[1:] or HEADLINE
    for name in (n for n in queries if any(n.startswith(w) for w in wanted)):
        runs = []
        for _ in range(repeats):
            started = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
        print(name, seconds[name], [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
