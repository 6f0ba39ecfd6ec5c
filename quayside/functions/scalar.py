"""Scalar expressions as built-in Spark ``Column`` functions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_op(*parts: ColumnOrName | str, sep: str | None = None) -> Column:
    """``a || sep || b``: any NULL part makes the result NULL (unlike concat_ws)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i and sep is not None:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.concat(*cols)


def split_first(s: ColumnOrName, delim: str = "_") -> Column:
    """``SPLIT(s, delim)[SAFE_ORDINAL(1)]``: the text before the first delimiter."""
    return F.split_part(_c(s), F.lit(delim), F.lit(1))


# Fixed value: letters/underscore/dash prefix followed by digits to the end.
ALPHA_PREFIX_DIGITS = r"^[a-zA-Z_-]+([0-9]+$)"


def strip_alpha_prefix(s: ColumnOrName) -> Column:
    """'AB-12' → '12'; anything not of the form prefix+digits is unchanged."""
    return F.regexp_replace(_c(s), ALPHA_PREFIX_DIGITS, "$1")


def json_int(s: ColumnOrName, path: str) -> Column:
    """``CAST(JSON_QUERY(s, path) AS INT64)``."""
    return F.get_json_object(_c(s), path).cast("bigint")


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``SAFE_DIVIDE``: NULL when the divisor is 0 (plain ``/`` raises under ANSI)."""
    return F.try_divide(_c(a), _c(b))


def nullif(a: ColumnOrName, value) -> Column:
    return F.nullif(_c(a), F.lit(value))


def null_safe_ratio(total: Column, n: Column) -> Column:
    """``COALESCE(SUM(x),0) / COALESCE(NULLIF(COUNT(x),0),1)``: never divides by zero."""
    return F.coalesce(total, F.lit(0)) / F.coalesce(F.nullif(n, F.lit(0)), F.lit(1))


def hash_record(parts: Sequence[Column], sep: str = "#") -> Column:
    """SHA-1 hex of the ``sep``-joined attribute strings."""
    return F.sha1(concat_op(*parts, sep=sep))


# Fixed value: placeholder the surrogate-key macro substitutes for NULL parts.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(cols: Sequence[ColumnOrName]) -> Column:
    """MD5 hex of the '-'-joined parts, NULL parts replaced by a fixed marker."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


def zero_fallback(value: ColumnOrName, other: ColumnOrName) -> Column:
    """``CASE WHEN v = 0 THEN other ELSE v END``."""
    v = _c(value)
    return F.when(v == 0, _c(other)).otherwise(v)
