from quayside.operators import quality as Q


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, None, "y")], "k long, s string, t string")
    assert Q.not_null(df, "s").count() == 1
    assert [r.k for r in Q.unique(df, "k").collect()] == [1]
    assert Q.accepted_values(df, "t", ["x"], allow_null=True).count() == 1
    assert Q.accepted_values(df, "t", ["x"]).count() == 2
    assert Q.compound_unique(df, ["k", "s"]).count() == 0
    parent = spark.createDataFrame([(1,)], "pk long")
    assert [r.k for r in Q.relationships(df, "k", parent, "pk").collect()] == [2]


def test_suite_one_row_per_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k long, s string")
    checks = [Q.Check("unique", "m", ("k",)), Q.Check("not_null", "m", ("s",))]
    rows = {(r.check, r.n_violations) for r in Q.run_suite(checks, {"m": df}).collect()}
    assert rows == {("unique", 1), ("not_null", 0)}
