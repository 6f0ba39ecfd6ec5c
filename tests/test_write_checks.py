"""Row checks counted while the rows are written: right counts, no further scan."""
import os

from pyspark.sql import functions as F

from quayside.catalog import shared_project
from quayside.operators import quality as Q
from quayside.operators import sinks
from quayside.plans.run import run_models
from conftest import SF_SMALL

CHECKS = [Q.Check("not_null", "m", ("k",)), Q.Check("accepted_values", "m", ("s",), values=("a", "b"), allow_null=True),
          Q.Check("accepted_values", "m", ("s",), values=("a",)), Q.Check("unique", "m", ("k",)), Q.Check("not_null", "other", ("k",))]


def _rows(spark, n=1000):
    number = F.col("id")
    return spark.range(n).select(F.when(number % 10 != 0, number).alias("k"), (number % 3).alias("day"),
                                 F.when(number % 4 == 0, "a").when(number % 4 == 1, "b").when(number % 4 == 2, "c").alias("s"))


def _jobs(spark, group, write):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    write()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_counts_of_a_write_without_another_job(spark, tmp_dir):
    df = _rows(spark)
    checks = Q.WriteChecks("m", CHECKS)
    path = os.path.join(tmp_dir, "t")
    plain = _jobs(spark, "plain", lambda: sinks.insert_overwrite(df, path, partition_by=["day"], cluster_by=["k"]))
    seen = _jobs(spark, "watched", lambda: sinks.insert_overwrite(df, path, partition_by=["day"], cluster_by=["k"], watch=checks.watch))
    assert seen == plain > 0
    got = [(r["check"], r["columns"], r["n_violations"], r["n_rows"]) for r in checks.results()]
    # clustered writes sample their input in a job before; it does not count twice
    assert got == [("not_null", "k", 100, 1000), ("accepted_values", "s", 250, 1000), ("accepted_values", "s", 750, 1000)]
    suite = Q.run_suite([c for c in CHECKS if c.model == "m" and c.kind != "unique"], {"m": spark.read.parquet(path)}).collect()
    assert sorted((r.check, r.columns, r.n_violations) for r in suite) == sorted(g[:3] for g in got)


def test_empty_write_and_no_checks(spark, tmp_dir):
    checks = Q.WriteChecks("m", CHECKS)
    sinks.write_table(_rows(spark).where("k < 0"), os.path.join(tmp_dir, "e"), cluster_by=["k"], watch=checks.watch)
    assert {(r["n_violations"], r["n_rows"]) for r in checks.results()} == {(0, 0)}
    none = Q.WriteChecks("nothing", CHECKS)
    sinks.write_table(_rows(spark), os.path.join(tmp_dir, "n"), watch=none.watch)
    assert none.results() == []


def test_a_run_reports_its_row_checks(spark, tmp_dir):
    p = shared_project(spark, SF_SMALL).fork()
    names = ["metric_fill_rate", "stg_unit_snapshot"]
    paths = run_models(p, names, tmp_dir)
    got = {(r["check"], r["model"], r["columns"]): (r["n_violations"], r["n_rows"]) for r in p.write_checks}
    declared = {(c.kind, c.model, ",".join(c.columns)) for c in Q.MODEL_CHECKS if c.model in names and c.kind in ("not_null", "accepted_values")}
    assert set(got) == declared and len(got) == 5
    for (check, model, column), (violations, rows) in got.items():
        written = spark.read.parquet(paths[model])
        assert rows == written.count()
        if check == "not_null":
            assert violations == Q.not_null(written, column).count()
