"""Relational building blocks shared by the pipelines.

Each helper is a short composition of DataFrame operators; none of them
collects data to the driver or starts a job.  Join strategies are left to
statistics and AQE.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- joins -------------------------------------------------------------------------------

def _null_salt(df: DataFrame, key: str) -> Column:
    """0 for rows with a key; a deterministic 1..1024 spread for NULL keys.

    Joined as a second equi-key against a constant 0 on the right, it leaves
    matches unchanged, while NULL-key rows (which never match) hash to many
    partitions instead of one; the input is read once.
    """
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1024)) + 1
    return F.when(F.col(key).isNull(), spread).otherwise(F.lit(0).cast("bigint"))


def anti_join(left: DataFrame, right: DataFrame, on, right_filter: Column | None = None) -> DataFrame:
    """``LEFT JOIN r … WHERE r.key IS NULL`` as a ``left_anti`` join.

    Equal to the idiom whenever the tested right column is non-NULL on every
    match; NULL left keys never match, so such rows are kept, as in SQL — and
    they are spread over partitions, where a NULL-heavy key would form one
    hot partition.
    """
    if right_filter is not None:
        right = right.where(right_filter)
    if not isinstance(on, str):
        return left.join(right, on=on, how="left_anti")
    l = left.withColumn("__salt", _null_salt(left, on))
    r = right.select(F.col(on).alias("__rkey")).withColumn("__rsalt", F.lit(0).cast("bigint"))
    cond = (l[on] == r["__rkey"]) & (l["__salt"] == r["__rsalt"])
    return l.join(r, cond, "left_anti").drop("__salt")


def left_join_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` where many ``left_key`` are NULL.

    NULL keys never match; salted, they spread over partitions instead of all
    hashing to one.  Same result as the plain left join.
    """
    l = left.withColumn("__salt", _null_salt(left, left_key))
    r = right.withColumn("__rsalt", F.lit(0).cast("bigint"))
    cond = (l[left_key] == r[right_key]) & (l["__salt"] == r["__rsalt"])
    return l.join(r, cond, "left").drop("__salt", "__rsalt")


def lookup_join(left: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str = "inner", keys: DataFrame | None = None) -> DataFrame:
    """``left JOIN dim ON key = dim_key`` (``inner`` or ``left``) where few values of ``key`` hold most rows of ``left``.

    Shuffled by such a key, the rows of ``left`` would meet in as many tasks as there are values.  Only the rows of ``dim``
    that ``left`` names are broadcast, so ``left`` stays where it is; ``keys`` are rows to read the named values from
    (by default ``left``).  Same result as the plain join.
    """
    used = (left if keys is None else keys).select(F.col(key).alias("__used")).distinct()
    named = F.broadcast(dim.join(used, dim[dim_key] == used["__used"], "left_semi"))
    return left.join(named, key if key == dim_key else F.col(key) == F.col(dim_key), how)


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on=on, how="left_semi")


# --- top-1 per group -----------------------------------------------------------------------

def pick_first(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column],
               fn=F.row_number, n: int = 1, col_name: str = "_rk") -> DataFrame:
    """Keep the first ``n`` rows per ``keys`` by ``order`` (``QUALIFY fn() <= n``).

    With ``row_number`` and ``n == 1`` Catalyst plans a ``WindowGroupLimit``
    before the shuffle, so each task forwards only its local winners.
    ``order`` must be a total order (add tie-break columns) for a fixed pick.
    """
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(*order)
    return df.withColumn(col_name, fn().over(w)).where(F.col(col_name) <= n).drop(col_name)


def pick_rank_first(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column]) -> DataFrame:
    """``QUALIFY RANK() = 1``: all rows tied for first are kept."""
    return pick_first(df, keys, order, fn=F.rank)


def newest(df: DataFrame, column: str) -> DataFrame:
    """Rows with the greatest ``column`` (no row where all are NULL).

    The maximum is a scalar subquery in the filter, so on a table partitioned by
    ``column`` it becomes a partition filter and the scan opens the newest
    partition's files only; the maximum itself reads no data columns.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


# --- predicates ---------------------------------------------------------------------------------

def like_any(col: ColumnOrName, patterns: Iterable[str]) -> Column:
    """OR of LIKE patterns; a pattern without wildcards is an equality."""
    c = _c(col)
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def first_match(col: ColumnOrName, rules: Sequence[tuple[str, object]], default=None) -> Column:
    """Ordered ``CASE WHEN col LIKE p THEN v …``; first match wins, else ``default``."""
    c = _c(col)
    expr = None
    for pattern, value in rules:
        cond = c.like(pattern)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if default is None:
        return expr
    return expr.otherwise(F.lit(default))


def code_lookup(col: ColumnOrName, mapping: Sequence[tuple[object, object]], default: ColumnOrName | None = None) -> Column:
    """``CASE col WHEN k THEN v … ELSE default END``."""
    c = _c(col)
    expr = None
    for k, v in mapping:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    if default is None:
        return expr
    return expr.otherwise(_c(default))


def strict_flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN TRUE ELSE FALSE END``: NULL becomes FALSE."""
    return F.coalesce(cond, F.lit(False))


def flag_int(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END``."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_true(c: ColumnOrName) -> Column:
    """``x IS TRUE`` (NULL fails)."""
    return _c(c).eqNullSafe(F.lit(True))


def is_false(c: ColumnOrName) -> Column:
    """``x IS FALSE`` (NULL fails)."""
    return _c(c).eqNullSafe(F.lit(False))


# --- arrays -----------------------------------------------------------------------------------------

def explode_all_outer(df: DataFrame, array_cols: Sequence[tuple[str, str]], index: str | None = None) -> DataFrame:
    """Chained ``LEFT JOIN UNNEST(arr) AS alias`` (``LATERAL VIEW OUTER``).

    Several unnests in one FROM clause form the per-row product of the arrays;
    an empty or NULL array contributes one NULL.  Each ``posexplode_outer`` is a
    ``Generate`` node that pipelines inside the scan stage: no shuffle.  ``index`` names
    a column that numbers the combinations of a row from 0, the last array's elements changing first.
    """
    out = df.withColumn(index, F.lit(0).cast("bigint")) if index else df
    for array_col, alias in array_cols:
        kept = [c for c in out.columns if c != index]
        if index:
            out = out.select("*", F.posexplode_outer(array_col).alias("__at", alias))
            number = F.col(index) * F.greatest(F.size(array_col), F.lit(1)) + F.coalesce("__at", F.lit(0))
            out = out.select(*kept, alias, number.alias(index))
        else:
            out = out.withColumn(alias, F.explode_outer(F.col(array_col)))
    return out.drop(*[a for a, _ in array_cols if a not in {al for _, al in array_cols}])


# --- set operations -------------------------------------------------------------------------------------

def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def tag(df: DataFrame, **labels) -> DataFrame:
    return df.select("*", *[F.lit(v).alias(k) for k, v in labels.items()])
