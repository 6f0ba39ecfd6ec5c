"""The command line end to end, in its own process (it owns and stops its session)."""
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def _cli(*args, cwd):
    env = {**os.environ, "PYTHONPATH": ROOT}
    return subprocess.run([sys.executable, "-m", "quayside", *args], cwd=cwd, env=env,
                          capture_output=True, text=True, timeout=900)


def test_run_then_test(tmp_dir):
    target = os.path.join(tmp_dir, "targets")
    r = _cli("run", "--sf-dir", SF_SMALL, "--target", target, "--models", "metric_fill_rate,report_outbound",
             "--backfill-from", "1998-06-16", "--threads", "2", "--master", "local[2]", cwd=tmp_dir)
    assert r.returncode == 0, r.stderr[-2000:]
    assert {"report_date=1998-06-15", "report_date=1998-06-16"} <= set(os.listdir(os.path.join(target, "metric_fill_rate")))
    t = _cli("test", "--sf-dir", SF_SMALL, "--master", "local[2]", cwd=tmp_dir)
    lines = [ln for ln in t.stdout.splitlines() if ln.startswith(("PASS", "FAIL"))]
    assert len(lines) == 19
    # built from the sources, the inbound report stacks two branches twice: its key check fails, as in the reference
    assert t.returncode == 1 and any(ln.startswith("FAIL compound_unique report_inbound") for ln in lines)


def test_written_tables_are_tested(spark, tmp_dir):
    target = os.path.join(tmp_dir, "targets")
    from quayside.operators import quality as Q
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    names = sorted({c.model for c in Q.MODEL_CHECKS})
    paths = run_models(Project.for_sf_dir(spark, SF_SMALL, fixture_context()), names, target)
    rows = spark.read.parquet(paths["stg_unit_snapshot"])
    broken = spark.createDataFrame(rows.collect() * 2, rows.schema)
    broken.write.mode("overwrite").parquet(paths["stg_unit_snapshot"])
    t = _cli("test", "--target", target, "--master", "local[2]", cwd=tmp_dir)
    assert t.returncode == 1
    assert any(ln.startswith("FAIL unique stg_unit_snapshot") for ln in t.stdout.splitlines()), t.stdout + t.stderr[-500:]


def test_real_sources_need_a_run_time(tmp_dir):
    r = _cli("run", "--source", "country=/nowhere", "--target", tmp_dir, cwd=tmp_dir)
    assert r.returncode != 0 and "--as-of is required" in r.stderr
