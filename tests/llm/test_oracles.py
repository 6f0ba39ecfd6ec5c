"""Operators against their SQL where it decides: at sf0.01 the labels certify cutoffs."""
import duckdb
import pytest

from conftest import SF_ORACLE
from quayside.llm.queries import ORACLES, QUERIES
from quayside.sources.tables import DRIVER_TABLES, table_path
from tools.check_oracle import norm


@pytest.fixture(scope="module")
def duck_larger():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_ORACLE, t)}')")
    return con


def test_joint_cutoffs_bind_and_agree(spark, duck_larger):
    rel = duck_larger.sql(ORACLES["op2_quality_rules"])
    order = sorted(rel.columns)
    want = sorted(tuple(norm(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall())
    got = QUERIES["op2_quality_rules"](spark, SF_ORACLE).select(*order).collect()
    assert sorted(tuple(norm(v) for v in r) for r in got) == want
    assert sum(not r["kept"] and not r["base_failed"] for r in got) > 10  # rules reject, not only the base check
