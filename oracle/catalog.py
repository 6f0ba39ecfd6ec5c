"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from oracle import models_sql as MS
from oracle.sql import build

ORACLES: dict[str, str] = {}


def oracle(key: str, final_sql: str) -> None:
    ORACLES[key] = build(final_sql)


def _pipeline(key: str) -> None:
    oracle(key, f"SELECT * FROM om_{key}")


# --- pipelines -------------------------------------------------------------------------------
from quayside.catalog import PIPELINE_KEYS  # noqa: E402

for _k in PIPELINE_KEYS:
    _pipeline(_k)

# --- calendar ----------------------------------------------------------------------------------
oracle("dim_date", MS.calendar_sql(
    "(SELECT DISTINCT CAST(x AS DATE) AS d FROM (SELECT o_orderdate AS x FROM orders UNION ALL "
    "SELECT l_shipdate FROM lineitem) WHERE x IS NOT NULL)") + "\nORDER BY date_actual")
oracle("gen_date_range", MS.calendar_sql(
    "(SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), "
    "INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"))


# operator entries register themselves on import
from oracle import operator_sql  # noqa: E402,F401
