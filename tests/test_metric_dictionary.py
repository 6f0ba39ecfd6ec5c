"""Dictionary metrics: shared scans, variations, filters, final aggregations, refusals by name."""
import contextlib
import io
import json
import os

import pytest

from quayside.operators import metric_dictionary as MD
from quayside.plans import operator_queries as OQ

ENTRY = {"metric_name": "Share", "model": "facts", "numerator": "late", "numerator_aggregation_function": "sum",
         "denominator": "n", "denominator_aggregation_function": "sum"}


def _facts(spark, path):
    spark.createDataFrame(
        [(1, "2025-01-01", 2, 10, "a"), (1, "2025-01-01", 3, 10, "b"), (2, "2025-01-01", 1, 0, "a"), (None, "2025-01-01", 4, 8, None)],
        "site int, report_date string, late int, n int, kind string").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _rows(df):
    return sorted(((r.site, r.metric_id, r.numerator, r.denominator, r.metric_value) for r in df.collect()), key=str)


def test_variations_inherit_filter_and_finish(spark, tmp_dir):
    facts = _facts(spark, os.path.join(tmp_dir, "facts"))
    metrics = MD.parse({7: {**ENTRY, "variation": {
        "A": {"metric_name": "Share of a", "filter": "kind = 'a'"},
        "B": {"metric_name": "On time", "final_aggregation": "denominator - numerator"},
        "C": {"metric_name": "Kinds", "numerator": "kind", "numerator_aggregation_function": "count_distinct",
              "denominator": 1, "denominator_aggregation_function": "already_aggregated", "final_aggregation": "numerator"}}}})
    assert [m.metric_id for m in metrics] == ["7", "7.A", "7.B", "7.C"]
    got = _rows(MD.evaluate_all(metrics, {"facts": facts}.__getitem__, ["site"]))
    assert got == sorted([
        (1, "7", 5.0, 20.0, 0.25), (2, "7", 1.0, 0.0, None), (None, "7", 4.0, 8.0, 0.5),
        (1, "7.A", 2.0, 10.0, 0.2), (2, "7.A", 1.0, 0.0, None),  # no row without a kind passes the filter
        (1, "7.B", 5.0, 20.0, 15.0), (2, "7.B", 1.0, 0.0, -1.0), (None, "7.B", 4.0, 8.0, 4.0),
        (1, "7.C", 2.0, 1.0, 2.0), (2, "7.C", 1.0, 1.0, 1.0), (None, "7.C", 0.0, 1.0, 0.0)], key=str)


def test_metrics_of_one_model_share_a_scan_and_their_sides(spark, tmp_dir):
    facts = _facts(spark, os.path.join(tmp_dir, "facts"))
    metrics = MD.parse({n: {**ENTRY, "metric_name": f"m{n}", "final_aggregation": final}
                        for n, final in enumerate(["numerator", "denominator", "safe_divide(numerator,denominator)"])})
    assert list(MD.plan(metrics)) == [("facts", "report_date", True)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        MD.evaluate_all(metrics, {"facts": facts}.__getitem__, ["site"]).explain()
    assert buf.getvalue().count("FileScan parquet") == 1
    assert buf.getvalue().count("partial_sum(") == 2  # two sides for three metrics


def test_rows_as_they_are_need_no_shuffle(spark, tmp_dir):
    facts = _facts(spark, os.path.join(tmp_dir, "facts"))
    metrics = MD.parse({1: {"metric_name": "Late", "model": "facts", "numerator": "late", "filter": "late > 1"}})
    df = MD.evaluate_all(metrics, {"facts": facts}.__getitem__, ["site"])
    assert _rows(df) == [(1, "1", 2.0, 1.0, 2.0), (1, "1", 3.0, 1.0, 3.0), (None, "1", 4.0, 1.0, 4.0)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "Exchange" not in buf.getvalue()


@pytest.mark.parametrize("change, word", [
    ({"colour": "red"}, "colour"), ({"model": None}, "model"), ({"numerator_aggregation_function": "mode"}, "mode"),
    ({"denominator_aggregation_function": "already_aggregated"}, "denominator")])
def test_faults_are_refused_by_name(change, word):
    with pytest.raises(ValueError, match=word):
        MD.parse({1: {**ENTRY, **change}})


def test_json_and_yaml_files_agree(tmp_dir):
    path = os.path.join(os.path.dirname(OQ.__file__), "metric_dictionary.yml")
    yaml = pytest.importorskip("yaml")
    with open(path, encoding="utf-8") as f, open(os.path.join(tmp_dir, "d.json"), "w", encoding="utf-8") as out:
        json.dump(yaml.safe_load(f), out)
    assert MD.load(os.path.join(tmp_dir, "d.json")) == MD.load(path)


def test_an_empty_table_gives_no_rows(spark, tmp_dir):
    facts = _facts(spark, os.path.join(tmp_dir, "facts")).where("false")
    assert _rows(MD.evaluate_all(MD.parse({1: ENTRY}), {"facts": facts}.__getitem__, ["site"])) == []
