"""deterministic sampling keyed by hashes, never by ``rand``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.functions.hashing import uniform_from_key


#: Equal slices of the hash range [0, 1) in which a day's negatives are counted.
HASH_SLICES = 4096


def negative_subsample(df: DataFrame, max_rows_per_day: int, seed: int = 42) -> DataFrame:
    """per calendar day keep every positive; when the day has more than
    ``max_rows_per_day`` rows keep exactly ``max(0, max_rows_per_day - positives)``
    negatives, the ones with the smallest (hash(seed, txn_id), txn_id).

    A day is one huge group, so no window runs over a day's rows: negatives are
    counted per (day, hash slice) with map-side combine, running counts over that
    small table (at most ``HASH_SLICES`` rows a day) tell which slices are in
    whole and which one slice holds the quota's end, and only that slice's rows
    (a 1/``HASH_SLICES`` share of the day's) are ranked.
    """
    neg = (1 - F.col("is_laundering")).cast("bigint")
    d = df.withColumns({"_day": F.to_date("timestamp"), "_h": uniform_from_key(seed, "txn_id")})
    d = d.withColumn("_slice", F.floor(F.col("_h") * HASH_SLICES).cast("int"))
    slices = d.groupBy("_day", "_slice").agg(F.count(F.lit(1)).alias("_rows"), F.sum(neg).alias("_neg"))
    day = Window.partitionBy("_day")
    rows, positives = F.sum("_rows").over(day), F.sum(F.col("_rows") - F.col("_neg")).over(day)
    quota = F.when(rows > max_rows_per_day, F.greatest(F.lit(max_rows_per_day) - positives, F.lit(0))).otherwise(rows)
    before = F.coalesce(F.sum("_neg").over(day.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = slices.select("_day", "_slice", "_neg", (quota - before).alias("_left"))
    j = d.join(left, ["_day", "_slice"])
    whole = j.filter((F.col("is_laundering") == 1) | (F.col("_left") >= F.col("_neg")))
    edge = j.filter((F.col("is_laundering") == 0) & (F.col("_left") > 0) & (F.col("_left") < F.col("_neg")))
    rank = F.row_number().over(Window.partitionBy("_day").orderBy("_h", "txn_id"))
    edge = edge.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_left"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))


def fanout_sample(edges: DataFrame, n: int, node: str = "dst", seed: int = 42, key: str = "txn_id") -> DataFrame:
    """at most ``n`` edges per ``node`` (smallest hash first).

    ``row_number() <= n`` with a literal ``n`` plans as a WindowGroupLimit:
    each task keeps only its own top ``n`` per node before the shuffle, so a
    hub node never ships all its edges.
    """
    w = Window.partitionBy(node).orderBy(uniform_from_key(seed, key), F.col(key))
    return edges.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
