"""Deterministic per-row hash buckets.

A row's bucket depends only on its id and a salt, so splits, folds and A/B
routing need no shuffle, no sort and no driver state, and give the same
answer when a task is retried on another executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def unit_hash(id_col: Column | str, salt: str | Column) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of md5(id || '#' || salt).

    ``salt`` is a fixed string or a per-row column (e.g. the model name).
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    s = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat(c.cast("string"), F.lit("#"), s))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_TWO_POW_32)


def unit_hash_sql(id_sql: str, salt: str, salt_is_sql: bool = False) -> str:
    """The same bucket as DuckDB SQL text (for oracle queries).

    ``salt`` is a fixed string, or SQL text when ``salt_is_sql`` is set.
    """
    s = salt if salt_is_sql else "'" + salt.replace("'", "''") + "'"
    return (
        f"(CAST(CAST(concat('0x', substr(md5(concat({id_sql}, '#', {s})), 1, 8)) AS BIGINT) AS DOUBLE)"
        f" / 4294967296.0)"
    )
