"""Bench of the headline jobs: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores.  Every query is
executed completely (all rows and columns are computed, nothing is kept); the
first run warms the JVM up and the median of three more runs counts.  Scratch
tables go to a shared folder named by ``spark.checkpoint.dir``, as on a cluster.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spreadlab.catalog import all_queries  # noqa: E402
from spreadlab.session import local_session  # noqa: E402

HEADLINE = (
    "job_01_pair_zscores",              # all-pairs spread statistics, 200 series
    "job_02_run_monitor",               # period changes and best levels
    "job_02_run_monitor_long_periods",
    "job_03_universe_build",
    "job_04_portfolio_build",
    "job_05_quote_build",
    "job_06_spread_history_build",
    "job_07_reconciliation",
    "job_08_history_load",              # five feeds into history tables
    "snk_05_keyed_upsert",
    "st_02_merge_latest",
    "agg_10_describe",
    "dq_06_table_profile",
    "join_08_orphans",
    "cus_01_standardize",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench", shuffle_partitions=int(cores) if cores.isdigit() else 8,
                          checkpoint_dir=tempfile.mkdtemp(prefix="spreadlab-bench-"))
    spark.conf.set("spark.sql.ui.explainMode", "simple")
    queries, measured, first = all_queries(), {}, {}
    for name in HEADLINE:
        run = lambda: queries[name](spark, folder)
        first[name] = round(seconds(run), 3)
        measured[name] = round(statistics.median(seconds(run) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "headline_jobs_total", "value": round(sum(measured.values()), 3), "unit": "sec",
        "queries": measured, "first_run": first, "sf": os.path.basename(folder.rstrip("/")), "cpus": cores}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
