"""Registry of named queries: a Spark builder and, where SQL can say it, a DuckDB oracle.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame that reads the
driver's tables under ``sf_dir`` (or data Spark derives from them). Column
names match the oracle's exactly; doubles are rounded to 6 places and counts
are BIGINT on both sides so values hash equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ringwatch.sources.transfers import DUCKDB_T_SQL

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn`` as query ``name`` with an optional DuckDB oracle body.

    The oracle body may refer to ``T`` (the transfers view with ``pattern_id``);
    the ``WITH T AS (...)`` prefix is added here.
    """
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query name {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = with_t(oracle)
        return fn
    return deco


def with_t(body: str) -> str:
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE T AS ({DUCKDB_T_SQL}),\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH T AS ({DUCKDB_T_SQL}),\n{body[5:]}"
    return f"WITH T AS ({DUCKDB_T_SQL})\n{body}"


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from ringwatch.plans import registered  # noqa: F401
