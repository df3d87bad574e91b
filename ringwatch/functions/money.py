"""Exact money arithmetic.

Amounts arrive as doubles that stand for decimal text. Each is taken as an exact
decimal with ``SCALE`` places (enough for crypto currencies); an amount with more
places is an error, never rounded away. Sums run over two integers per amount,
whole units and ``10^-SCALE`` units: BIGINT adds stay inside whole-stage codegen,
are exact, and do not depend on the order rows meet in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 8
UNIT = 10 ** SCALE
DECIMAL = f"decimal(28,{SCALE})"


def _exact(amount: Column | str) -> Column:
    c = F.col(amount) if isinstance(amount, str) else amount
    d = c.cast(DECIMAL)
    return F.when(d.cast("double") == c, d).when(c.isNull(), d).otherwise(
        F.raise_error(F.concat(F.lit(f"amount with more than {SCALE} decimals: "), c.cast("string"))).cast(DECIMAL))


def whole_part(amount: Column | str) -> Column:
    """Whole units of an amount (toward zero)."""
    return _exact(amount).cast("bigint")


def unit_part(amount: Column | str) -> Column:
    """The rest, in ``10^-SCALE`` units."""
    d = _exact(amount)
    return ((d - d.cast("bigint").cast("decimal(20,0)")) * F.lit(UNIT)).cast("bigint")


def to_amount(whole: Column | str, units: Column | str) -> Column:
    """Double from summed whole and fractional parts."""
    w = F.col(whole) if isinstance(whole, str) else whole
    u = F.col(units) if isinstance(units, str) else units
    carry = (u - u % F.lit(UNIT)) / F.lit(UNIT)
    return (w + carry.cast("bigint")).cast("double") + (u % F.lit(UNIT)).cast("double") / F.lit(float(UNIT))


def duckdb_sum(amount_sql: str) -> str:
    """Argument of the same exact sum in DuckDB."""
    return f"CAST({amount_sql} AS DECIMAL(28,{SCALE}))"
