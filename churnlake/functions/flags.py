"""Flag expressions with the reference's null semantics.

In the reference a comparison with a missing value is simply False, so
``== v`` gives 0 and ``!= v`` gives 1 for nulls.  Spark's plain ``==`` gives
NULL; these helpers use null-safe equality so every flag is 0 or 1.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_value(c: Column | str, value) -> Column:
    """Boolean ``c == value``; null -> False."""
    return _c(c).eqNullSafe(F.lit(value))


def flag_eq(c: Column | str, value) -> Column:
    """Integer flag ``c == value``; null -> 0."""
    return is_value(c, value).cast("int")


def flag_ne(c: Column | str, value) -> Column:
    """Integer flag ``c != value``; null -> 1."""
    return (~is_value(c, value)).cast("int")


def flag_in(c: Column | str, values: Iterable) -> Column:
    """Integer flag of membership; null -> 0."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False)).cast("int")


def flag_cmp(cond: Column) -> Column:
    """Integer flag of a comparison; null operand -> 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def flag_any_eq(cols: Iterable[Column | str], value) -> Column:
    """Integer flag: any of the columns equals ``value``; nulls count as False."""
    cond = None
    for c in cols:
        e = is_value(c, value)
        cond = e if cond is None else (cond | e)
    return cond.cast("int")


def flag_icontains(c: Column | str, needle: str) -> Column:
    """Integer flag: case-insensitive substring; null -> 0 (stated deviation)."""
    return F.coalesce(F.lower(_c(c)).contains(needle.lower()), F.lit(False)).cast("int")


def ntz_lit(ts) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime, independent of any time zone."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
