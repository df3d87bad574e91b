"""Join helpers: ring-id attachment (C1), as-of join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NO_PATTERN = -1
MATCH_KEY = ("timestamp", "from_account", "to_account", "amount_paid")


def keep_first_by_key(rings: DataFrame, key=MATCH_KEY, order=("pattern_id", "hop")) -> DataFrame:
    """Deterministic keep-first: the row with the smallest ``order`` per key (file order)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rings.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def attach_pattern_ids(transfers: DataFrame, rings: DataFrame) -> DataFrame:
    """Left join on the 4-column natural key; unmatched rows get -1.

    The ring table is deduplicated first, so the join cannot multiply
    transfers. The keep-first step shuffles the ring table, so AQE sees its
    real size and turns the join into a broadcast when it is small: a
    runtime-checked bound in bytes, no extra job and no hint.
    """
    lookup = keep_first_by_key(rings.select(*MATCH_KEY, "pattern_id", "hop")).select(*MATCH_KEY, "pattern_id")
    return (transfers.join(lookup, list(MATCH_KEY), "left")
            .withColumn("pattern_id", F.coalesce(F.col("pattern_id"), F.lit(NO_PATTERN)).cast("int")))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              right_cols: list[str], tie: str | None = None, bucket_seconds: int | None = 86400) -> DataFrame:
    """For every left row, the last right row with ``right_on <= left_on`` in the same ``by`` group.

    Both sides are unioned and sorted once per (``by``, time bucket), so one hot
    key is spread over its buckets; a right row sorts before a left row at the
    same instant (inclusive match). ``last(..., ignorenulls)`` over an
    unbounded-preceding frame carries the latest right values forward. A left
    row whose bucket holds no earlier right row takes the last right row of the
    latest earlier bucket, found on a per-key table with one row per bucket
    (bounded by the time span). No candidate pairs are formed.
    ``tie`` orders right rows that share ``right_on`` (the last one wins).

    ``bucket_seconds=None`` sorts whole groups: only for tables whose rows per
    key are bounded, such as one row per key and day.
    """
    if bucket_seconds:
        return _asof_bucketed(left, right, by, left_on, right_on, right_cols, tie, bucket_seconds)
    lcols = left.columns
    rsel = [F.col(c).alias(f"_r_{c}") for c in right_cols]
    tie_col = F.col(tie) if tie else F.lit(0)
    l = left.select("*", F.col(left_on).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"),
                    *[F.lit(None).cast(right.schema[c].dataType).alias(f"_r_{c}") for c in right_cols])
    r = right.select(*[F.col(b) for b in by], F.col(right_on).alias("_t"), F.lit(0).alias("_side"),
                     tie_col.cast("long").alias("_tie"), *rsel)
    u = l.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    packed = F.struct(*[F.col(f"_r_{c}").alias(c) for c in right_cols])
    u = u.withColumn("_m", F.last(F.when(F.col("_side") == 0, packed), ignorenulls=True).over(w))
    return u.filter(F.col("_side") == 1).select(*lcols, *[F.col(f"_m.{c}").alias(c) for c in right_cols])


def _asof_bucketed(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
                   right_cols: list[str], tie: str | None, bucket_seconds: int) -> DataFrame:
    from ringwatch.sources.transfers import epoch_seconds

    bucket = lambda c: F.floor(epoch_seconds(c) / F.lit(bucket_seconds)).cast("bigint")
    tie_col = (F.col(tie) if tie else F.lit(0)).cast("long")
    lcols = left.columns
    packed = F.struct(*[F.col(c).alias(c) for c in right_cols])
    r = right.select(*by, F.col(right_on).alias("_t"), tie_col.alias("_tie"), bucket(right_on).alias("_b"),
                     packed.alias("_v"))
    l = left.select("*", F.col(left_on).alias("_t"), bucket(left_on).alias("_b"))
    # 1. inside each (key, bucket): the latest right row at or before the left row
    u = (l.select(*lcols, *[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)], "_t", "_b",
                  F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"),
                  F.lit(None).cast(r.schema["_v"].dataType).alias("_v"))
         .unionByName(r.select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)], "_t", "_b",
                               F.lit(0).alias("_side"), "_tie", "_v"), allowMissingColumns=True))
    keys = [f"_k{i}" for i in range(len(by))]
    w = Window.partitionBy(*keys, "_b").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    inner = (u.withColumn("_in", F.last("_v", ignorenulls=True).over(w)).filter(F.col("_side") == 1)
             .drop("_v", "_tie", "_side"))
    # 2. per key and bucket, the last right row of the bucket; carried forward to later buckets
    last = (r.groupBy(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)], "_b")
            .agg(F.max_by("_v", F.struct("_t", "_tie")).alias("_v")).withColumn("_side", F.lit(1)))
    # A bucket's mark sorts before that bucket's own last right row: strictly earlier buckets only.
    marks = inner.select(*keys, "_b").distinct().withColumn("_side", F.lit(0)).withColumn(
        "_v", F.lit(None).cast(r.schema["_v"].dataType))
    wb = Window.partitionBy(*keys).orderBy("_b", "_side").rowsBetween(Window.unboundedPreceding, 0)
    prev = (marks.unionByName(last).withColumn("_prev", F.last("_v", ignorenulls=True).over(wb))
            .filter(F.col("_side") == 0).select(*keys, "_b", "_prev"))
    j = inner.join(prev, [*keys, "_b"], "left")
    m = F.coalesce(F.col("_in"), F.col("_prev"))
    return j.select(*lcols, *[m[c].alias(c) for c in right_cols])
