"""Deterministic pseudo-random numbers from row keys.

``rand(seed)`` depends on partitioning and task order, so it changes when a
lost executor's tasks are recomputed or the cluster size changes. A hash of
(seed, key) is the same everywhere and equals DuckDB's ``md5`` of the same text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_48 = float(2 ** 48)


def uniform_from_key(seed: int | str, key: Column | str) -> Column:
    """Uniform double in [0, 1): first 48 bits of md5("<seed>:<key>") / 2^48."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}:"), k.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") / F.lit(_TWO_48)


def duckdb_uniform_from_key(seed: int | str, key_sql: str) -> str:
    """The same value in DuckDB SQL."""
    return (f"CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 12)) AS BIGINT)"
            f" / {_TWO_48!r}")
