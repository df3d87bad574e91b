"""Degree table and degree summary; G1 node list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.quantiles import quantiles
from ringwatch.operators.summary import role_rows


def degree_table(edges: DataFrame) -> DataFrame:
    """Per account out-, in- and total degree (transfers, not distinct partners).

    One role explode and one ``groupBy`` instead of a full outer join of two
    aggregates: receive-only accounts appear naturally, self transfers count
    on both sides.
    """
    r = role_rows(edges)
    return r.groupBy("account").agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).cast("bigint").alias("out_degree"),
        F.sum(F.when(F.col("role") == 1, 1).otherwise(0)).cast("bigint").alias("in_degree"),
    ).withColumn("degree", F.col("out_degree") + F.col("in_degree"))


def degree_summary(edges: DataFrame) -> DataFrame:
    """Accounts, edges, mean, median (interpolated), max out, max in, p99 (nearest).

    The plain aggregates and the rank-selected quantiles are two one-row
    results; they are combined as long rows and pivoted, not joined.
    """
    d = degree_table(edges)
    stats = d.agg(F.count(F.lit(1)).cast("double").alias("n_accounts"),
                  F.sum("out_degree").cast("double").alias("n_edges"),
                  F.avg("degree").alias("mean_degree"), F.max("out_degree").cast("double").alias("max_out_degree"),
                  F.max("in_degree").cast("double").alias("max_in_degree"))
    q = quantiles(d, "degree", {"median_degree": ("linear", 0.5), "p99_degree": ("nearest", 0.99)})
    q = q.select(F.col("median_degree").cast("double"), F.col("p99_degree").cast("double"))
    names_a, names_b = stats.columns, q.columns
    long = (stats.unpivot([], names_a, "metric", "value")
            .unionByName(q.unpivot([], names_b, "metric", "value")))
    wide = long.groupBy().pivot("metric", names_a + names_b).agg(F.first("value"))
    return wide.select(F.col("n_accounts").cast("bigint").alias("n_accounts"),
                       F.col("n_edges").cast("bigint").alias("n_edges"), "mean_degree", "median_degree",
                       F.col("max_out_degree").cast("bigint").alias("max_out_degree"),
                       F.col("max_in_degree").cast("bigint").alias("max_in_degree"), "p99_degree")


def degree_percentiles(edges: DataFrame, qs=(0.5, 0.75, 0.9, 0.99)) -> DataFrame:
    """L2: degree at the given quantiles (nearest rank) and the maximum."""
    d = degree_table(edges)
    spec = {f"p{int(round(q * 100))}": ("nearest", q) for q in qs}
    spec["max"] = ("nearest", 1.0)
    return quantiles(d, "degree", spec)


def node_list(edges: DataFrame, extra_accounts: DataFrame | None = None) -> DataFrame:
    """Every account seen as payer or payee (plus optional extra accounts), once,
    with a first-appearance order key (payers first, then payees, then extras)."""
    roles = role_rows(edges, ["timestamp", "txn_id"])
    first = roles.groupBy("account").agg(F.min(F.struct("role", "timestamp", "txn_id")).alias("first_seen"))
    if extra_accounts is not None:
        extra = extra_accounts.select(F.col("account"), F.struct(F.lit(2).alias("role"),
                                      F.lit(None).cast("timestamp_ntz").alias("timestamp"),
                                      F.lit(None).cast("bigint").alias("txn_id")).alias("first_seen"))
        first = first.unionByName(extra).groupBy("account").agg(F.min("first_seen").alias("first_seen"))
    return first
