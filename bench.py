"""Benchmark: headline queries and the layer jobs at one scale factor.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
Each query is timed from building its DataFrame to the end of a ``noop`` write, which
computes every row without collecting anything to the driver. ``layer_jobs`` runs
bronze -> silver -> gold with all writes into a fresh scratch folder. For comparison
the script also times the per-check counting of the original design (two counts per
check, one scan each) against the one-pass metric aggregate.

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripmart.operators import bronze  # noqa: E402
from tripmart.plans import catalog, jobs  # noqa: E402
from tripmart.session import local_session  # noqa: E402
from tripmart.sources import fixtures as fx  # noqa: E402

HEADLINE = [
    "trip_flagged",          # bronze: 31 checks + verdict
    "summary_all",           # bronze: every metric, one aggregate
    "curated",               # silver: conform, de-duplicate, zone joins, derive
    "weekly_summary",        # silver weekly summary
    "weekly_kpis",           # gold: KPIs per week and borough
    "orphan_pickup_zones",   # referential integrity (anti join)
    "top_week_boroughs",     # gold top-k
    "silver_kpi_overview",   # global aggregate over curated
]


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def per_check_counts(spark, sf: str) -> None:
    """The original way: a count per verdict and two counts per check, no cache."""
    flagged = bronze.flag_trips(fx.raw_trips(spark, sf))
    flagged.count()
    flagged.filter(F.col("dq_pass")).count()
    for c in bronze.check_columns(flagged):
        flagged.filter(F.col(c)).count()
        flagged.filter(~F.col(c)).count()
    dom = bronze.domain_check_columns(flagged)
    flagged.filter(" AND ".join(dom)).count()
    flagged.count()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:  # local run: goes with its end
        run(sf, cpus, scratch)


def run(sf: str, cpus: int, scratch: str) -> None:
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus), driver_memory="16g",
                          event_log_dir=None)
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    qs = catalog.queries()
    _noop(qs["trips_raw"](spark, sf))  # JVM warm-up, not timed

    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = _timed(lambda n=name: _noop(qs[n](spark, sf)))
    times["layer_jobs"] = _timed(lambda: jobs.run_all(
        spark, fx.raw_trips(spark, sf), fx.raw_zones(spark, sf), os.path.join(scratch, "out")))

    comparison = {
        "metrics_one_pass": times["summary_all"],
        "metrics_per_check_counts": _timed(lambda: per_check_counts(spark, sf)),
    }
    m = re.search(r"sf([0-9.]+)$", sf)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "comparison": comparison,
        "sf": float(m.group(1)) if m else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
