"""The analyses the reference reports, as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.operators.quantiles import quantiles
from ringwatch.operators.selection import select_quantiles
from ringwatch.operators.summary import role_rows
from ringwatch.sources.transfers import seconds_between


def daily_rate(df: DataFrame, flag_factor: float = 10.0) -> DataFrame:
    """L1: per calendar day rows, positives, rate; ``flagged`` when the day's rate
    exceeds ``flag_factor`` x the overall rate. The day table has one row per
    day, so the overall totals come from a window over that small table."""
    daily = df.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("is_laundering").cast("bigint").alias("laundering"))
    every = Window.partitionBy(F.lit(0))
    overall = F.sum("laundering").over(every) / F.sum("transactions").over(every)
    rate = F.col("laundering") / F.col("transactions")
    return daily.select("day", "transactions", "laundering", rate.alias("laundering_rate"),
                        (rate > F.lit(flag_factor) * overall).cast("int").alias("flagged"))


def top_senders(df: DataFrame, n: int = 10) -> DataFrame:
    """L3: the ``n`` accounts sending most transfers, with their own laundering rate
    (ties broken by account). A top-k report: the limit is the feature."""
    g = df.groupBy("from_account").agg(F.count(F.lit(1)).alias("sent"),
                                        F.sum("is_laundering").cast("bigint").alias("laundering"))
    return (g.withColumn("laundering_rate", F.col("laundering") / F.col("sent"))
             .orderBy(F.col("sent").desc(), F.col("from_account")).limit(n))


def pattern_shapes(rings: DataFrame) -> DataFrame:
    """L4: per shape attempts (rings), transfers, average transfers per ring."""
    per = rings.groupBy("pattern_type", "pattern_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("pattern_type").agg(
        F.count(F.lit(1)).alias("attempts"), F.sum("n").cast("bigint").alias("transfers"),
        (F.sum("n") / F.count(F.lit(1))).alias("avg_transfers"))


def ring_sizes(rings: DataFrame) -> DataFrame:
    """Per ring: transfers, distinct accounts (both sides), span in days."""
    acc = role_rows(rings, ["pattern_id"]).groupBy("pattern_id").agg(F.countDistinct("account").alias("accounts"))
    per = rings.groupBy("pattern_id").agg(
        F.count(F.lit(1)).alias("transfers"),
        (seconds_between(F.min("timestamp"), F.max("timestamp")) / F.lit(86400.0)).alias("days"))
    return per.join(acc, "pattern_id")


def stack_columns(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Long form ``(*keys, feature, value)``: one narrow explode, so several
    per-column statistics come out of one grouped pass."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keys, F.explode(arr).alias("_s")).select(*keys, "_s.feature", "_s.value")


def ring_shape(rings: DataFrame) -> DataFrame:
    """Median and max of ring transfers, accounts and days (one stacked pass)."""
    cols = ["transfers", "accounts", "days"]
    q = quantiles(stack_columns(ring_sizes(rings).withColumn("_g", F.lit(0)), ["_g"], cols), "value",
                  {"median": ("linear", 0.5), "max": ("nearest", 1.0)}, ["_g", "feature"])
    wide = q.groupBy("_g").pivot("feature", cols).agg(F.first("median").alias("median"), F.first("max").alias("max"))
    return wide.select(*[F.col(f"{c}_max").alias(f"max_{c}") for c in cols],
                       *[F.col(f"{c}_median").alias(f"median_{c}") for c in cols])


def label_coverage(with_ids: DataFrame) -> DataFrame:
    """Positives inside a labelled ring vs outside."""
    pos = F.col("is_laundering") == 1
    in_ring = F.col("pattern_id") != -1
    agg = with_ids.agg(
        F.sum(F.when(pos, 1).otherwise(0)).cast("bigint").alias("positives"),
        F.sum(F.when(pos & in_ring, 1).otherwise(0)).cast("bigint").alias("positives_in_ring"),
        F.sum(F.when(in_ring, 1).otherwise(0)).cast("bigint").alias("ring_transfers"))
    share = F.when(F.col("positives") > 0, F.col("positives_in_ring") / F.col("positives"))
    return agg.select("*", share.alias("share_in_ring"), (F.lit(1.0) - share).alias("share_outside"))


FEATURE_MEDIANS = ("amount_paid", "sender_n_sent_before", "receiver_n_received_before", "sender_sent_last_24h")
FLAG_RATES = ("is_cross_currency", "is_self_transfer", "is_same_bank")


def feature_by_class(features: DataFrame) -> DataFrame:
    """Per label: rows, medians of key features, rates of the row flags.

    Rows and rates come with the sketches of the medians' first pass; the second pass selects
    the medians exactly. ``features`` is read twice: hand in a stored table.
    """
    rates = [F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(f"rate_{c}") for c in FLAG_RATES]]
    q = select_quantiles(features, list(FEATURE_MEDIANS), {"median": ("linear", 0.5)}, ["is_laundering"], rates)
    names = ["rows", *[f"rate_{c}" for c in FLAG_RATES]]
    return q.groupBy("is_laundering").agg(
        *[F.first(c).alias(c) for c in names],
        *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"median_{c}") for c in FEATURE_MEDIANS])


def format_share(df: DataFrame) -> DataFrame:
    """Per payment format rows, positives, rate and share of all rows / all positives."""
    g = df.groupBy("payment_format").agg(F.count(F.lit(1)).alias("rows"),
                                          F.sum("is_laundering").cast("bigint").alias("positives"))
    every = Window.partitionBy(F.lit(0))  # one row per format: a tiny table
    return g.select("payment_format", "rows", "positives", (F.col("positives") / F.col("rows")).alias("rate"),
                    (F.col("rows") / F.sum("rows").over(every)).alias("share_rows"),
                    (F.col("positives") / F.sum("positives").over(every)).alias("share_positives"))
