"""Assemble oracle queries: named CTE fragments + a final SELECT, for DuckDB.

A fragment may reference other fragments by name; ``build`` walks those
references and emits the needed fragments in dependency order as one WITH
clause.  Placeholders like ``{TODAY}`` are replaced by SQL expressions of
the fixed ``as_of`` instant, so the oracle derives its dates itself.
"""

from __future__ import annotations

import re

from oracle.fixtures_sql import FIXTURES

AS_OF = "TIMESTAMP '1998-06-17 12:00:00'"
AS_OF_TZ = "TIMESTAMPTZ '1998-06-17 12:00:00+00'"

PLACEHOLDERS = {
    "{AS_OF}": AS_OF,
    "{AS_OF_TZ}": AS_OF_TZ,
    "{TODAY}": f"CAST({AS_OF} AS DATE)",
    "{NOW_NY}": f"timezone('America/New_York', {AS_OF_TZ})",
    "{TODAY_NY}": f"CAST(timezone('America/New_York', {AS_OF_TZ}) AS DATE)",
    # Sunday that starts the week of a date: DuckDB dayofweek is 0 = Sunday
}

FRAGMENTS: dict[str, str] = dict(FIXTURES)


def register(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql


def render(sql: str, as_of: str | None = None) -> str:
    """Replace placeholders; ``as_of`` ('YYYY-MM-DD HH:MM:SS') renders another run's instant."""
    values = dict(PLACEHOLDERS)
    if as_of is not None:
        values = {k: v.replace(AS_OF_TZ, f"TIMESTAMPTZ '{as_of}+00'").replace(AS_OF, f"TIMESTAMP '{as_of}'")
                  for k, v in values.items()}
    for k, v in values.items():
        sql = sql.replace(k, v)
    return sql


def _refs(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [n for n in FRAGMENTS if n in words]


def build(final_sql: str, as_of: str | None = None) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()) -> None:
        if name in seen:
            return
        if name in stack:
            raise ValueError(f"cycle through {name}")
        for dep in _refs(FRAGMENTS[name]):
            if dep != name:
                visit(dep, stack + (name,))
        seen.add(name)
        order.append(name)

    for n in _refs(final_sql):
        visit(n)
    if not order:
        return render(final_sql, as_of)
    ctes = ",\n".join(f"{n} AS ({FRAGMENTS[n]}\n)" for n in order)
    return render(f"WITH {ctes}\n{final_sql}", as_of)


def build_runs(name: str, daily: list[str], runs: list[str]) -> str:
    """UNION ALL of fragment ``name`` over several runs: the fragments in ``daily`` are rendered for each run's instant, all
    others for the fixed one (tables that stand as they are while metrics are run for other days)."""
    needed: list[str] = []

    def visit(n: str) -> None:
        for dep in _refs(FRAGMENTS[n]):
            if dep != n:
                visit(dep)
        if n not in needed:
            needed.append(n)

    visit(name)
    ctes = [f"{n} AS ({render(FRAGMENTS[n])}\n)" for n in needed if n not in daily]
    for k, run in enumerate(runs):
        for n in [n for n in needed if n in daily]:
            sql = render(FRAGMENTS[n], run)
            for d in daily:
                sql = re.sub(rf"\b{d}\b", f"{d}_{k}", sql)
            ctes.append(f"{n}_{k} AS ({sql}\n)")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(f"SELECT * FROM {name}_{k}" for k in range(len(runs)))
