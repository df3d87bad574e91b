"""Dataset summary in one aggregate over payer/payee role rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.sources.transfers import whole_days_between


def role_rows(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Each transfer twice: (account, role=0) for the payer, (account, role=1) for the payee.

    Replaces a full outer join of payer and payee aggregates (C2): one
    ``explode`` is a narrow operation, and the following ``groupBy`` combines
    map-side, so a hub account never ships raw rows.
    """
    extra = extra or []
    roles = F.array(F.struct(F.col("from_account").alias("account"), F.lit(0).alias("role")),
                    F.struct(F.col("to_account").alias("account"), F.lit(1).alias("role")))
    return df.select(*extra, F.explode(roles).alias("_r")).select(*extra, "_r.account", "_r.role")


def summarise(df: DataFrame, approx_accounts: bool = False) -> DataFrame:
    """One row: n_transactions, n_accounts, date_min, date_max, n_laundering,
    laundering_rate (0.0 when empty), span_days, one_in (1 / rate, rounded; null at rate 0)."""
    r = role_rows(df, ["timestamp", "is_laundering"])
    payer = F.col("role") == 0
    distinct = (F.approx_count_distinct("account") if approx_accounts else F.countDistinct("account"))
    agg = r.agg(
        F.count(F.when(payer, 1)).cast("bigint").alias("n_transactions"),
        distinct.cast("bigint").alias("n_accounts"),
        F.min("timestamp").alias("date_min"),
        F.max("timestamp").alias("date_max"),
        F.coalesce(F.sum(F.when(payer, F.col("is_laundering")).otherwise(0)), F.lit(0)).cast("bigint")
         .alias("n_laundering"))
    rate = F.when(F.col("n_transactions") > 0, F.col("n_laundering") / F.col("n_transactions")).otherwise(F.lit(0.0))
    return agg.select(
        "*", rate.alias("laundering_rate"),
        whole_days_between("date_min", "date_max").alias("span_days"),
        F.when(rate > 0, F.round(F.lit(1.0) / rate).cast("bigint")).alias("one_in"))


#: Registers of a stored sketch, as a power of two: a relative standard error of 1.04 / 2**(12/2) = 1.6 %.
SKETCH_LG = 12


def daily_account_sketches(df: DataFrame, lg_k: int = SKETCH_LG) -> DataFrame:
    """D2, to be stored: one row per day with activity, ``day``, ``transfers`` and the HLL ``sketch`` of the
    accounts on either side. A new day is appended without touching the stored ones; null
    accounts are not counted, a null timestamp belongs to no day."""
    r = role_rows(df.filter(F.col("timestamp").isNotNull()), ["timestamp"])
    return r.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).cast("bigint").alias("transfers"),
        F.hll_sketch_agg("account", F.lit(lg_k)).alias("sketch"))


def accounts_by_period(sketches: DataFrame, period: Column) -> DataFrame:
    """Estimated distinct accounts of any ``period`` (an expression over ``day``; null: the day is left out),
    from stored daily sketches alone: sketches unite, so no transfer is read again and no
    account counts twice. One row per period: ``period``, ``transfers``, ``accounts``."""
    s = sketches.withColumn("period", period).filter(F.col("period").isNotNull())
    return s.groupBy("period").agg(F.sum("transfers").alias("transfers"),
                                   F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("accounts"))
