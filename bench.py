"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8), forcing the full result with a no-op write,
and prints one JSON line:
  {"metric": "total_warm_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

The HR tables are first derived from the driver's tables and written once as
typed parquet snapshots under the shared checkpoint folder (timed as
``load_tables``); the queries then read those snapshots, as a deployment reads
its stored tables. Each query is run once to warm up (JIT, file listing, Python
workers) and then ``$BENCH_REPEAT`` times (default 3); the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "run_payroll", "run_payroll_deductions", "bonus_amount", "missing_hour_deductions",
    "missing_day_deductions", "unpaid_leave_deductions_corrected", "attendance_this_month",
    "leave_ledger", "is_on_leave_range", "highest_ranked_available", "recompute_salaries",
    "drop_leave_attendance", "upsert_attendance", "fk_violations", "check_violations",
    "login_attempt_flags", "submit_annual_leaves", "submit_unpaid_approvals",
    "upperboard_decide_annual", "hr_decide_annual_corrected", "hr_decide_unpaid_corrected",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    keys = sys.argv[1:] or HEADLINE
    from hrforge.catalog import BUILDERS
    from hrforge.session import checkpoint_dir, get_session
    from hrforge.sources.fixtures import materialize
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "16g"})
    root = f"{checkpoint_dir(spark).rstrip('/')}/bench-tables-{uuid.uuid4().hex}"
    t0 = time.perf_counter()
    tables = materialize(spark, sf_dir, root)
    load_sec = round(time.perf_counter() - t0, 3)
    print(f"# load_tables: {load_sec}s -> {root}", file=sys.stderr, flush=True)

    def run(key: str) -> float:
        t0 = time.perf_counter()
        BUILDERS[key](tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    out: dict[str, float] = {}
    first: dict[str, float] = {}
    for k in keys:
        first[k] = round(run(k), 3)
        out[k] = round(statistics.median(run(k) for _ in range(repeat)), 3)
        print(f"# {k}: first {first[k]}s warm {out[k]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_warm_sec", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "first_run": first,
                      "load_tables_sec": load_sec,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
