"""Benchmark on ``$BENCH_SF_DIR`` (default sf0.1) with ``local[$BENCH_CPUS]``.

Headline (``value``): a full run — every configured target model built and
written through its sink (tables, partition overwrites, keyed merges) with
``$BENCH_THREADS`` concurrent models, then the data-quality suite over the
written tables — into empty targets.  With ``$BENCH_DAILY`` 1, ``queries`` has
the daily path next to it (a second run over the existing targets, the next day's incremental run,
a seven-day backfill of the fill rate), and then attributes time per model
from a second, sequential pass (each model's own materialisation; its upstream models
were built before it).  Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.operators import quality as Q  # noqa: E402
from quayside.operators import sinks  # noqa: E402
from quayside.plans.context import RunContext, fixture_context  # noqa: E402
from quayside.plans.fill_rate import fill_rate_for_days  # noqa: E402
from quayside.plans.project import Project  # noqa: E402
from quayside.plans.run import MATERIALIZATIONS, run_models  # noqa: E402
from quayside.session import build_session, checkpoint_dir  # noqa: E402

DAG_ORDER = [
    "dim_warehouse", "dim_date", "first_reservation_event", "load_reservation_match", "load_gate_out",
    "dim_yard_trailer", "latest_inbound_visit", "units_base", "units_happy_sad", "units_json_fallback",
    "units_priority", "units_carton_qc_xd", "units_logic", "units_median_backup", "stg_units_reservation",
    "stg_unit_snapshot", "stg_yard_utilization", "metric_fill_rate", "metric_inbound_trailers",
    "metric_on_yard_units", "metric_throughput_variance", "metric_yard_utilization",
    "report_inbound", "report_outbound",
]


def quality(p: Project) -> None:
    frames = {c.model: p.ref(c.model) for c in Q.MODEL_CHECKS}
    Q.run_suite(Q.MODEL_CHECKS, frames).collect()


def full_run(spark, sf_dir: str, targets: str, threads: int, days: int = 0) -> float:
    """Seconds for a run of all targets ``days`` after the fixture's day, and the checks over them."""
    base = fixture_context()
    p = Project.for_sf_dir(spark, sf_dir, RunContext(as_of=base.as_of + dt.timedelta(days=days), params=base.params))
    t0 = time.time()
    paths = run_models(p, list(MATERIALIZATIONS), targets, threads=threads)
    Q.run_suite(Q.MODEL_CHECKS, {c.model: spark.read.parquet(paths[c.model]) for c in Q.MODEL_CHECKS}).collect()
    return round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    threads = int(os.environ.get("BENCH_THREADS", "4"))
    spark = build_session(f"local[{cpus}]",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2))))
    # warm-up: JVM and parquet footers
    spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).selectExpr("count(*)").collect()

    # headline: full run of every target, independent models concurrently
    targets = os.path.join(checkpoint_dir(spark), "quayside-bench", uuid.uuid4().hex)
    total = full_run(spark, sf_dir, targets, threads)
    daily: dict[str, float] = {}
    if os.environ.get("BENCH_DAILY") == "1":  # three times the work of the headline
        daily["second_run"] = full_run(spark, sf_dir, targets, threads)
        daily["next_day_run"] = full_run(spark, sf_dir, targets, threads, days=1)
        p = Project.for_sf_dir(spark, sf_dir, fixture_context())
        t0 = time.time()
        last = p.ctx.current_date
        sinks.insert_overwrite(fill_rate_for_days(p, last - dt.timedelta(days=6), last),
                               os.path.join(targets, "metric_fill_rate"), cluster_by=["warehouse_id"])
        daily["backfill_7_days_fill_rate"] = round(time.time() - t0, 3)

    # attribution: sequential pass, one model at a time on a fresh project
    p = Project.for_sf_dir(spark, sf_dir, fixture_context())
    times: dict[str, float] = {}
    for name in DAG_ORDER:
        t1 = time.time()
        p.ref(name)
        times[name] = round(time.time() - t1, 3)
    t1 = time.time()
    quality(p)
    times["quality_suite"] = round(time.time() - t1, 3)
    times["sequential_total"] = round(sum(times.values()), 3)
    times |= daily

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "full_run_seconds", "value": total, "unit": "sec", "queries": times,
                      "threads": threads, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
