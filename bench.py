"""Time the job and its headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of cores. The whole job
is timed as `pipeline`, from text files to published tables; each query after it is
timed on its own. All are warm and the median of their runs. BENCH_ALL=1 times
every registered query instead of the headline ones.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries  # noqa: E402
from ledgerloom.session import build_session, shared_folder  # noqa: E402

HEADLINES = (
    "scan_raw", "dedup_rows", "grain_check", "price_glitch", "cap_quantity_p99", "repair_net",
    "stock_spikes", "corrections", "high_value_flag", "reconcile_first_purchase",
    "quarantine_route", "settlement_recon", "headcount_recon", "run_summary", "top_customers",
    "category_yoy", "po_delay_by_hub", "master_join", "master_join_all", "revenue_per_employee",
    "operating_margin", "tamil_month_profile", "festival_months", "lead_time_range",
    "surge_ratio", "period_compare",
)
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    app = spark.sparkContext.applicationId

    def job(n: int) -> None:
        queries.run_job(spark, SF_DIR, f"{shared_folder(spark)}/bench-{app}-{n}")

    job(0)
    times["pipeline"] = statistics.median(seconds(lambda n=n: job(n)) for n in range(1, RUNS + 1))
    registered = queries.registered()
    for name in registered if os.environ.get("BENCH_ALL") else HEADLINES:
        query = registered[name]

        def run(query=query) -> None:
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()
        times[name] = statistics.median(seconds(run) for _ in range(RUNS))
        print(f"{name}: {times[name]:.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
