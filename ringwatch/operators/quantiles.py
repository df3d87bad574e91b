"""Exact quantiles by rank selection over value counts.

Values are first counted per (group, value) — a map-side-combined aggregate
whose size is the number of distinct values, not rows — then running counts
(:func:`prefix_sum`, skew-safe) locate the value at any rank. Ranks follow
the "nearest" rule (``round((n - 1) q) + 1``) or linear interpolation between
the two neighbouring ranks (median).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.prefix import prefix_sum


def value_counts(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    g = list(groups or [])
    return df.groupBy(*g, value).agg(F.count(F.lit(1)).alias("_n"))


def nearest_rank_col(n: Column, q: float) -> Column:
    return F.floor((n - 1) * F.lit(q) + F.lit(0.5)).cast("bigint") + 1


def quantiles(df: DataFrame, value: str, spec: dict[str, tuple[str, float]],
              groups: list[str] | None = None, moments: bool = False) -> DataFrame:
    """One row per group with one column per ``spec`` entry.

    ``spec``: output name -> (method, q); method ``nearest`` (a data value) or
    ``linear`` (interpolated between neighbouring ranks; ``linear`` at 0.5 is
    the median). ``moments`` adds ``n`` and ``mean`` per group, computed from
    the same value counts.
    """
    g = list(groups or [])
    counts = value_counts(df, value, g)
    sums, outs, tots = ["_n"], ["_cum"], ["_size"]
    if moments:  # value x count, summed per group, gives the mean from the same pass
        counts = counts.withColumn("_vn", F.col(value).cast("double") * F.col("_n"))
        sums, outs, tots = ["_n", "_vn"], ["_cum", "_cumv"], ["_size", "_vsum"]
    cum = prefix_sum(counts, [value], sums, outs, partition_cols=g, total_cols=tots)
    if moments:
        cum = cum.withColumn("_mean", F.col("_vsum") / F.col("_size"))
    aggs = [F.first("_size").alias("n"), F.first("_mean").alias("mean")] if moments else []
    for name, (method, q) in spec.items():
        n = F.col("_size")
        if method == "nearest":
            r = nearest_rank_col(n, q)
            aggs.append(F.min(F.when(F.col("_cum") >= r, F.col(value))).alias(name))
        elif method == "linear":
            pos = (n - 1).cast("double") * F.lit(q)
            lo, frac = F.floor(pos).cast("bigint") + 1, pos - F.floor(pos)
            v_lo = F.min(F.when(F.col("_cum") >= lo, F.col(value)))
            v_hi = F.min(F.when(F.col("_cum") >= lo + 1, F.col(value)))
            f = F.max(frac)  # same for every row of the group
            aggs.append(F.when(f > 0, v_lo + (F.coalesce(v_hi, v_lo) - v_lo) * f).otherwise(v_lo)
                        .cast("double").alias(name))
        else:
            raise ValueError(method)
    return cum.groupBy(*g).agg(*aggs)
