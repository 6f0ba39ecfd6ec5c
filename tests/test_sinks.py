"""Sinks: idempotence, partition overwrite, keyed upsert."""
import datetime as dt
import os

from quayside.operators import sinks


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_full_refresh_idempotent(spark, tmp_dir):
    df = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    path = os.path.join(tmp_dir, "t")
    sinks.write_table(df, path, cluster_by=["n_regionkey"])
    first = _rows(spark.read.parquet(path), "n_nationkey", "n_name")
    sinks.write_table(df, path, cluster_by=["n_regionkey"])
    assert _rows(spark.read.parquet(path), "n_nationkey", "n_name") == first
    assert len(first) == df.count()


def test_insert_overwrite_keeps_other_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    spark.createDataFrame([(d1, 1, 10.0), (d2, 1, 20.0)], "report_date date, warehouse_id long, v double") \
        .transform(lambda d: sinks.insert_overwrite(d, path, cluster_by=["warehouse_id"]) or d)
    spark.createDataFrame([(d2, 1, 99.0), (d2, 2, 5.0)], "report_date date, warehouse_id long, v double") \
        .transform(lambda d: sinks.insert_overwrite(d, path) or d)
    got = _rows(spark.read.parquet(path), "report_date", "warehouse_id", "v")
    assert got == [(d1, 1, 10.0), (d2, 1, 99.0), (d2, 2, 5.0)]


def test_merge_upsert_updates_listed_columns_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    schema = "k long, name string, v double, created string"
    spark.createDataFrame([(1, "a", 1.0, "t0"), (2, "b", 2.0, "t0")], schema).write.parquet(path)
    upd = spark.createDataFrame([(2, "B", 20.0, "t1"), (3, "c", 3.0, "t1"), (3, "c", 3.0, "t1")], schema)
    first = _rows(sinks.merge_upsert(spark, upd, path, key=["k"], update_columns=["v"]), "k", "name", "v", "created")
    assert first == [(1, "a", 1.0, "t0"), (2, "b", 20.0, "t0"), (3, "c", 3.0, "t1")]
    again = sinks.merge_upsert(spark, upd, path, key=["k"], update_columns=["v"])
    assert _rows(again, "k", "name", "v", "created") == first  # idempotent


def test_incremental_hash_antijoin(spark):
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    p = Project.for_sf_dir(spark, "/root/testdata/sf0.001", fixture_context())
    full = p.build("dim_warehouse")
    p.targets["dim_warehouse"] = full
    assert p.build("dim_warehouse").count() == 0  # nothing changed → nothing re-emitted


def test_partitioned_merge_touches_only_new_partitions(spark, tmp_dir):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    schema = "k string, time_base_date date, v double, created string"
    path = os.path.join(tmp_dir, "tall")
    first = spark.createDataFrame([("a", d1, 1.0, "r1"), ("b", d2, 2.0, "r1")], schema)
    sinks.merge_upsert_partitions(spark, first, path, ["k", "time_base_date"], ["v"], ["time_base_date"])
    d1_files = sorted(os.listdir(os.path.join(path, "time_base_date=2024-01-01")))
    upd = spark.createDataFrame([("b", d2, 20.0, "r2"), ("c", d3, 3.0, "r2"), ("c", d3, 3.0, "r2")], schema)
    out = sinks.merge_upsert_partitions(spark, upd, path, ["k", "time_base_date"], ["v"], ["time_base_date"])
    got = sorted((r.k, r.time_base_date, r.v, r.created) for r in out.collect())
    assert got == [("a", d1, 1.0, "r1"), ("b", d2, 20.0, "r1"), ("c", d3, 3.0, "r2")]
    # the untouched partition kept its files
    assert sorted(os.listdir(os.path.join(path, "time_base_date=2024-01-01"))) == d1_files
    # same content as a whole-table merge
    whole = os.path.join(tmp_dir, "whole")
    sinks.merge_upsert(spark, first, whole, ["k", "time_base_date"], ["v"])
    ref = sinks.merge_upsert(spark, upd, whole, ["k", "time_base_date"], ["v"])
    assert sorted((r.k, r.time_base_date, r.v, r.created) for r in ref.collect()) == got


def test_run_models_twice_is_idempotent(spark, tmp_dir):
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    names = ["dim_warehouse", "dim_yard_trailer", "metric_fill_rate", "report_outbound", "stg_yard_utilization"]
    root = os.path.join(tmp_dir, "targets")
    first = {}
    for attempt in range(2):
        p = Project.for_sf_dir(spark, "/root/testdata/sf0.001", fixture_context())
        paths = run_models(p, names, root)
        snap = {n: sorted(tuple(str(v) for v in r) for r in spark.read.parquet(paths[n]).collect()) for n in names}
        if attempt == 0:
            first = snap
    assert snap == first and all(first[n] for n in ["dim_warehouse", "metric_fill_rate"])


def test_incremental_runs_keep_unchanged_rows(spark, tmp_dir):
    """An incremental run of the warehouse dimension re-emits only changed hashes, so
    rows that did not change keep their modification time (S11); the trailer
    dimension's incremental run reads the last six months only (S12)."""
    import datetime as _dt

    from quayside.plans.context import RunContext, fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    root = os.path.join(tmp_dir, "inc")
    base = fixture_context()
    early = RunContext(as_of=_dt.datetime(1998, 3, 30, 12), params=base.params)
    run_models(Project.for_sf_dir(spark, "/root/testdata/sf0.001", early), ["dim_warehouse"], root)
    run_models(Project.for_sf_dir(spark, "/root/testdata/sf0.001", base), ["dim_warehouse"], root)
    rows = spark.read.parquet(os.path.join(root, "dim_warehouse")).collect()
    modified = {r.dwh_modified_timestamp for r in rows}
    created = {r.dwh_creation_timestamp for r in rows}
    assert created == {_dt.datetime(1998, 3, 30, 12)}
    assert modified == {_dt.datetime(1998, 3, 30, 12), _dt.datetime(1998, 6, 17, 12)}  # only changed rows moved on


def test_interrupted_publish_is_completed_by_the_next_upsert(spark, tmp_dir):
    """A run that died after the old target files were removed leaves a pending
    record; the next upsert completes the copy before merging its own rows."""
    path = os.path.join(tmp_dir, "t")
    schema = "k long, v double, created string"
    spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "a")], schema).write.parquet(path)
    # the earlier run: merged result staged, pending record written, copy died half-way
    stage = os.path.join(tmp_dir, "stage")
    spark.createDataFrame([(1, 10.0, "a"), (2, 2.0, "a"), (3, 3.0, "b")], schema).write.parquet(stage)
    spark.createDataFrame([(stage, "", "", "parquet")], sinks._PENDING_SCHEMA).write.mode("overwrite").parquet(
        sinks._pending_path(spark, path))
    spark.createDataFrame([(2, 2.0, "a")], schema).write.mode("overwrite").parquet(path)  # half-written target
    out = sinks.merge_upsert(spark, spark.createDataFrame([(4, 4.0, "c")], schema), path, ["k"], ["v"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10.0, "a"), (2, 2.0, "a"), (3, 3.0, "b"), (4, 4.0, "c")]
    assert not sinks.recover_pending(spark, path)  # nothing left pending


def test_concurrent_run_equals_sequential(spark, tmp_dir):
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    names = ["metric_fill_rate", "stg_yard_utilization", "metric_throughput_variance", "report_outbound", "dim_date"]
    out = {}
    for threads in (1, 4):
        p = Project.for_sf_dir(spark, "/root/testdata/sf0.001", fixture_context())
        paths = run_models(p, names, os.path.join(tmp_dir, f"t{threads}"), threads=threads)
        out[threads] = {n: sorted(tuple(str(v) for v in r) for r in spark.read.parquet(paths[n]).collect()) for n in names}
    assert out[1] == out[4]


def test_merge_refuses_two_different_rows_for_a_key(spark, tmp_dir):
    import pytest
    schema = "k long, v double"
    path = os.path.join(tmp_dir, "t")
    with pytest.raises(ValueError, match="merge key"):
        sinks.merge_upsert(spark, spark.createDataFrame([(1, 1.0), (1, 2.0)], schema), path, ["k"], ["v"])
    assert sinks.read_table(spark, path) is None
    same = spark.createDataFrame([(1, 1.0), (1, 1.0)], schema)
    assert sinks.merge_upsert(spark, same, path, ["k"], ["v"]).count() == 1


def test_one_row_per_key_does_not_depend_on_partitioning(spark):
    rows = [(k, v, None if v % 2 else "x") for k in range(20) for v in range(6)]
    df = spark.createDataFrame(rows, "k long, v long, s string")
    got = {tuple(sorted(map(tuple, sinks.one_row_per_key(df.repartition(n), ["k"]).collect()))) for n in (1, 3, 7)}
    assert got == {tuple((k, 5, None) for k in range(20))}


def test_only_a_missing_path_is_no_table(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException
    assert sinks.read_table(spark, os.path.join(tmp_dir, "none")) is None
    os.makedirs(os.path.join(tmp_dir, "empty"))
    with pytest.raises(AnalysisException):
        sinks.read_table(spark, os.path.join(tmp_dir, "empty"))


def test_interrupted_publish_is_completed_by_the_next_run(spark, tmp_dir):
    """The target is recovered before the run reads it for its incremental plan."""
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    root = os.path.join(tmp_dir, "targets")
    run = lambda: run_models(Project.for_sf_dir(spark, "/root/testdata/sf0.001", fixture_context()), ["dim_warehouse"], root)
    path = run()["dim_warehouse"]
    whole = sorted(map(str, spark.read.parquet(path).collect()))
    stage = os.path.join(tmp_dir, "stage")
    spark.read.parquet(path).write.parquet(stage)
    half = spark.createDataFrame(spark.read.parquet(path).limit(2).collect(), spark.read.parquet(path).schema)
    half.write.mode("overwrite").parquet(path)
    spark.createDataFrame([(stage, "", "", "parquet")], sinks._PENDING_SCHEMA).write.mode("overwrite").parquet(
        sinks._pending_path(spark, path))
    run()
    assert sorted(map(str, spark.read.parquet(path).collect())) == whole
    assert not os.path.exists(stage)


def test_second_run_builds_no_model_of_the_visits_again(spark, tmp_dir, monkeypatch):
    """The visits' second run recomputes dirty keys only; nothing is built in full, downstream
    models read the merged target, and no scratch table is left."""
    from quayside.plans import project as P
    from quayside.plans.context import fixture_context
    from quayside.plans.run import run_models
    P._load_models()
    built = []
    for name in ("first_reservation_event", "load_reservation_match", "load_gate_out", "dim_yard_trailer", "dim_warehouse"):
        monkeypatch.setitem(P.MODELS, name, lambda p, name=name, fn=P.MODELS[name]: (built.append(name), fn(p))[1])
    root = os.path.join(tmp_dir, "targets")
    names = ["dim_warehouse", "dim_yard_trailer", "stg_unit_snapshot"]
    models = ["dim_warehouse", "first_reservation_event", "load_gate_out", "load_reservation_match"]
    for expected in (models, ["dim_warehouse"]):
        built.clear()
        p = P.Project.for_sf_dir(spark, "/root/testdata/sf0.001", fixture_context())
        run_models(p, names, root)
        assert sorted(built) == expected
        assert not os.path.exists(p.materialize_dir)


def test_reports_keep_every_warehouse_without_a_name(spark, tmp_dir):
    """Warehouses the dimension does not name share a surrogate key, as do facility types of one warehouse: all their rows are written."""
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    ctx = fixture_context()
    root = os.path.join(tmp_dir, "targets")
    for add in (0, 1):  # the second run updates the rows of the first
        p = Project.for_sf_dir(spark, "/root/testdata/sf0.001", ctx)
        p._built["metric_yard_utilization"] = spark.createDataFrame(
            [(ctx.report_date, w, u + add, 50) for w, u in ((998, 5), (999, 7), (34, 7))],
            "report_date date, warehouse_id long, amount_of_units long, yard_capacity long")
        p._built["metric_fill_rate"] = spark.createDataFrame(
            [(w, "SP", ft, ctx.report_date, r + add, "daily") for w, ft, r in
             ((998, None, 0.5), (999, None, 0.25), (34, None, 0.25), (1, "MM", 0.75), (1, "FC", 0.5))],
            "warehouse_id long, ship_class string, is_middle_mile string, report_date date, fill_rate_mm double, cadence string")
        paths = run_models(p, ["report_inbound", "report_outbound"], root)
        inbound = spark.read.parquet(paths["report_inbound"]).where("metric_id = '174'").collect()
        assert sorted((r.warehouse_id, r.metric_numerator) for r in inbound) == [(34, 7.0 + add), (998, 5.0 + add), (999, 7.0 + add)]
        outbound = spark.read.parquet(paths["report_outbound"]).where("metric_id = '310'").collect()
        assert sorted((r.warehouse_id, r.is_middle_mile or "", r.metric_numerator) for r in outbound) == [
            (1, "FC", 0.5 + add), (1, "MM", 0.75 + add), (34, "", 0.25 + add), (998, "", 0.5 + add), (999, "", 0.25 + add)]
