"""Temporal split: tail cut (B8), assignment (B9), slices (B10), snapshot
index (B11), quantile boundaries (D3) and the split manifest (D4, D5, A3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.prefix import prefix_sum
from ringwatch.sources.transfers import ntz_lit, whole_days_between

SPLIT_NAMES = ("train", "validation", "test")


def ts_lit(value: dt.datetime):
    return ntz_lit(value)


def truncate_tail(df: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Keep rows strictly before ``cutoff``."""
    return df.filter(F.col("timestamp") < ts_lit(cutoff))


def assign_split(df: DataFrame, boundaries: tuple[dt.datetime, dt.datetime]) -> DataFrame:
    """Train / validation / test from the timestamp alone. Null timestamps must be rejected upstream."""
    train_end, val_end = boundaries
    return df.withColumn(
        "split",
        F.when(F.col("timestamp") < ts_lit(train_end), F.lit("train"))
         .when(F.col("timestamp") < ts_lit(val_end), F.lit("validation"))
         .otherwise(F.lit("test")))


def split_range(name: str, boundaries: tuple[dt.datetime, dt.datetime]) -> tuple[dt.datetime | None, dt.datetime | None]:
    train_end, val_end = boundaries
    ranges = {"train": (None, train_end), "validation": (train_end, val_end), "test": (val_end, None)}
    if name not in ranges:
        raise ValueError(f"unknown split: {name}")
    return ranges[name]


def time_slice(df: DataFrame, start: dt.datetime | None, end: dt.datetime | None) -> DataFrame:
    """Half-open ``[start, end)``. Literal bounds on ``timestamp`` push into the
    Parquet scan; when the table is day-partitioned the matching ``event_date``
    bounds prune whole directories too."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("timestamp") >= ts_lit(start))
        if "event_date" in df.columns:
            cond = cond & (F.col("event_date") >= F.lit(start.date()))
    if end is not None:
        cond = cond & (F.col("timestamp") < ts_lit(end))
        if "event_date" in df.columns:
            cond = cond & (F.col("event_date") <= F.lit(end.date()))
    return df.filter(cond)


def select_split(df: DataFrame, name: str, boundaries: tuple[dt.datetime, dt.datetime]) -> DataFrame:
    """Rows of one split as a range filter (never a filter on the derived label)."""
    start, end = split_range(name, boundaries)
    return time_slice(df, start, end)


def min_timestamp(df: DataFrame) -> dt.datetime | None:
    return df.agg(F.min("timestamp")).first()[0]


def snapshot_index(df: DataFrame, origin: dt.datetime | None = None) -> DataFrame:
    """Whole 24-hour periods since ``origin`` (default: the first transfer, not midnight)."""
    origin = origin or min_timestamp(df)
    return df.withColumn("snapshot", whole_days_between(ts_lit(origin), F.col("timestamp")).cast("int"))


def nearest_rank(n: int, q: float) -> int:
    """1-based rank picked by the "nearest" quantile rule: round((n - 1) * q) + 1."""
    x = (n - 1) * q
    return int(x + 0.5) + 1 if x >= 0 else 1


def timestamp_quantiles(df: DataFrame, qs: list[float]) -> list[dt.datetime | None]:
    """Discrete ("nearest") timestamp quantiles.

    Count per distinct timestamp (map-side combined; the table is bounded by
    distinct minutes, not rows), running counts via :func:`prefix_sum`, then
    one aggregate picks, for every q, the first timestamp whose running count
    reaches the target rank. Two small jobs; nothing but scalars reaches the
    driver.
    """
    n = df.count()
    if n == 0:
        return [None for _ in qs]
    counts = df.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n"))
    cum = prefix_sum(counts, ["timestamp"], ["n"], ["cum"])
    aggs = [F.min(F.when(F.col("cum") >= F.lit(nearest_rank(n, q)), F.col("timestamp"))).alias(f"q{i}")
            for i, q in enumerate(qs)]
    row = cum.agg(*aggs).first()
    return [row[f"q{i}"] for i in range(len(qs))]


def compute_boundaries(df: DataFrame, fractions: tuple[float, float] = (0.6, 0.2)) -> tuple[dt.datetime, dt.datetime]:
    """D3: (train_end, val_end) at the ``train`` and ``train + validation`` quantiles."""
    train_frac, val_frac = fractions
    a, b = timestamp_quantiles(df, [train_frac, train_frac + val_frac])
    return a, b


def split_stats(df: DataFrame, boundaries: tuple[dt.datetime, dt.datetime]) -> DataFrame:
    """Per split rows, positives, rate (8 dp), first and last instant."""
    return (assign_split(df, boundaries).groupBy("split").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_laundering").cast("bigint").alias("laundering"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"))
        .withColumn("laundering_rate", F.round(F.col("laundering") / F.col("transactions"), 8)))


def tail_rows_dropped(df: DataFrame, cutoff: dt.datetime) -> int:
    """Rows at or after the cutoff, in one pass."""
    return int(df.agg(F.sum(F.when(F.col("timestamp") >= ts_lit(cutoff), 1).otherwise(0))).first()[0] or 0)
