"""Command line: materialise models and run the data-quality checks.

    python -m quayside run  --sf-dir DIR --target DIR [--models a,b] [--as-of TS] [--threads N]
                            [--backfill-from DATE [--backfill-to DATE]]
    python -m quayside backfill --sf-dir DIR --target DIR --backfill-from DATE [--backfill-to DATE] [--models a,b]
    python -m quayside test --target DIR | --sf-dir DIR [--as-of TS]

``--sf-dir`` reads the stand-in sources derived from a driver-table folder;
``--source name=path`` (repeatable) points a logical source at a real table
instead, ``--database curated=prod_curated`` all declared sources of a database at the catalogue's tables;
both need ``--as-of``.  ``--backfill-from`` runs every day from
that date to ``--backfill-to`` (default: ``--as-of``); each day's run writes
its own partitions.  ``backfill`` writes the ``report_date`` metrics of all run days from
that date on in one pass per metric, over the written targets of their upstream models.  Both print a line for each
row check (not null, accepted values) of what they wrote, counted during the write.  ``test --target`` checks the written tables; without a
target it checks models built from the sources.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from quayside.operators import quality as Q
from quayside.plans.context import FIXTURE_AS_OF, FIXTURE_PARAMS, RunContext
from quayside.plans.project import Project
from quayside.plans.range_runs import RANGE_RUNS
from quayside.plans.run import MATERIALIZATIONS, backfill_metrics, run_models
from quayside.session import build_session, configure
from quayside.sources.registry import Sources


def _args(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="quayside")
    ap.add_argument("command", choices=["run", "backfill", "test"])
    ap.add_argument("--sf-dir", default=None)
    ap.add_argument("--source", action="append", default=[], help="logical source = path (parquet), or table:database.table")
    ap.add_argument("--database", action="append", default=[], help="declared database = database of the catalogue")
    ap.add_argument("--target", default=None)
    ap.add_argument("--models", default=None)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--backfill-from", default=None)
    ap.add_argument("--backfill-to", default=None)
    ap.add_argument("--threads", type=int, default=1)
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--cluster-sizing", action="store_true", help="apply the large-cluster partition sizing")
    return ap.parse_args(argv)


def _report(results: list[dict]) -> int:
    """One PASS/FAIL line per check; the number that failed."""
    for r in results:
        status = "PASS" if r["n_violations"] == 0 else "FAIL"
        print(f"{status} {r['check']} {r['model']}({r['columns']}) violations={r['n_violations']}")
    return sum(r["n_violations"] != 0 for r in results)


def main(argv: list[str] | None = None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    if a.as_of is None and not a.sf_dir and not (a.command == "test" and a.target):
        raise SystemExit("--as-of is required without --sf-dir")
    if a.command != "test" and not a.target:
        raise SystemExit(f"--target is required for {a.command}")
    if a.command == "backfill" and not a.backfill_from:
        raise SystemExit("--backfill-from is required for backfill")
    models = [m for m in (a.models or ",".join(RANGE_RUNS if a.command == "backfill" else MATERIALIZATIONS)).split(",") if m]
    spark = build_session(a.master)
    if a.cluster_sizing:
        configure(spark, cluster_sizing=True)
    paths = dict(s.split("=", 1) for s in a.source)
    src = Sources(spark, a.sf_dir, paths=paths, databases=dict(d.split("=", 1) for d in a.database))
    as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else FIXTURE_AS_OF
    params = dict(FIXTURE_PARAMS) if a.sf_dir else {}
    if a.command == "run":
        first = dt.date.fromisoformat(a.backfill_from) if a.backfill_from else as_of.date()
        last = dt.date.fromisoformat(a.backfill_to) if a.backfill_to else as_of.date()
        day = first
        while day <= last:  # one run per day; each writes its own partitions
            p = Project(spark, src, RunContext(as_of=dt.datetime.combine(day, as_of.time()), params=params))
            run_models(p, models, a.target, threads=a.threads)
            _report(p.write_checks)
            print(json.dumps({"as_of": str(p.ctx.as_of), "models": models}))
            day += dt.timedelta(days=1)
    elif a.command == "backfill":
        first = dt.date.fromisoformat(a.backfill_from)
        last = dt.date.fromisoformat(a.backfill_to) if a.backfill_to else as_of.date()
        bounds = {"manual_backfill": True, "backfill_start": first, "backfill_end": last}
        p = Project(spark, src, RunContext(as_of=as_of, params={**params, **bounds}))
        backfill_metrics(p, models, a.target)
        _report(p.write_checks)
        print(json.dumps({"first": str(first), "last": str(last), "models": models}))
    else:
        names = {c.model for c in Q.MODEL_CHECKS}
        if a.target:
            frames = {m: spark.read.parquet(os.path.join(a.target, m)) for m in names}
        else:
            p = Project(spark, src, RunContext(as_of=as_of, params=params))
            frames = {m: p.ref(m) for m in names}
        failed = _report([r.asDict() for r in Q.run_suite(Q.MODEL_CHECKS, frames).collect()])  # one row per check
        spark.stop()
        return 1 if failed else 0
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
