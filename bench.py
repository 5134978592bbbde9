"""Benchmark the headline queries.

Runs each query end to end from the test tables at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.

Every query is executed completely through the ``noop`` sink (all rows are
produced, nothing is collected to the driver). A warm-up query runs first so
JVM start-up is not charged to the first timed query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fct_ad_impressions",
    "fct_viewing_sessions",
    "fct_campaign_daily",
    "mart_platform_health",
    "mart_campaign_performance",
    "mart_advertiser_summary",
    "mart_advertiser_concentration",
    "mart_frequency_analysis",
    "mart_content_monetization",
    "recon_pacing_ratio",
    "weighted_allocation",
    "dq_report",
]


def default_driver_memory() -> str:
    """About 60 % of the machine's memory (the container limit when there is
    one), between 2 and 8 GiB: local mode runs every task in this one JVM."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    try:
        with open("/sys/fs/cgroup/memory.max") as f:
            limit = f.read().strip()
        if limit.isdigit():
            total = min(total, int(limit))
    except OSError:
        pass
    gib = max(2, min(8, int(total * 0.6) >> 30))
    return f"{gib}g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]

    from adlens.session import get_session
    from adlens.plans.catalog import queries

    spark = get_session(
        app="adlens-bench", master=f"local[{cpus}]",
        conf={"spark.sql.shuffle.partitions": str(max(cpus * 2, 8)),
              "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY",
                                                    default_driver_memory())})
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()

    # warm-up: JIT, parquet footers, broadcast-size checks of the dimensions
    q["dim_campaigns"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for key in (only or HEADLINE):
        t0 = time.perf_counter()
        q[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.perf_counter() - t0, 3)
        print(f"# {key}: {timings[key]}s", file=sys.stderr, flush=True)

    # dashboard reads: the five named reports over the built marts, each
    # fully produced in its presentation order (the reference's only
    # performance claim is that these reads take milliseconds)
    if not only:
        from adlens.operators.report import REPORTS, fetch
        from adlens.plans.catalog import wh
        w = wh(spark, sf_dir)
        for name in REPORTS:
            t0 = time.perf_counter()
            fetch(w, name).write.format("noop").mode("overwrite").save()
            timings[f"read_{name}"] = round(time.perf_counter() - t0, 3)
            print(f"# read_{name}: {timings[f'read_{name}']}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
