"""Fixed parameters and small helpers shared by the registered queries."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.operators.split import split_range
from ringwatch.sources.transfers import TRANSFER_COLUMNS, transfers_from_events

# Fixed values for the driver's transfers view T (FIXTURES.md §3).
TAIL_CUTOFF = dt.datetime(2024, 1, 29, 0, 0)
AS_OF = dt.datetime(2024, 1, 21, 0, 0)
SPLIT_FRACTIONS = (0.6, 0.2)
K_VALUES = (50, 100, 500, 1000, 5000)
SEED = 42

# DuckDB text of the same instants.
SQL_TAIL_CUTOFF = "TIMESTAMP '2024-01-29 00:00:00'"
SQL_AS_OF = "TIMESTAMP '2024-01-21 00:00:00'"


def T(spark: SparkSession, sf_dir: str, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Transfers contract columns only (no pattern_id), rows of ``[start, end)``; the bounds reach the scan."""
    return transfers_from_events(spark, sf_dir, start=start, end=end).select(*TRANSFER_COLUMNS)


def T_split(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One split of T before the tail, its bounds pushed into the scan."""
    start, end = split_range(name, frozen_split(spark, sf_dir))
    return T(spark, sf_dir, start, min(end or TAIL_CUTOFF, TAIL_CUTOFF))


def T_with_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers_from_events(spark, sf_dir, with_pattern=True)


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column so both engines hash the same text."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def data_key(df: DataFrame, *cols: str) -> str:
    """Digest of a table's rows over ``cols``: count, extremes and an order-free sum of row hashes.
    New, missing or changed rows give another key, whatever the files they lie in."""
    row = df.agg(F.count(F.lit(1)), F.min(cols[0]), F.max(cols[0]),
                 F.sum(F.xxhash64(*cols).cast("decimal(20,0)"))).first()
    return hashlib.sha256(repr(tuple(map(str, row))).encode()).hexdigest()[:32]


def freeze(t: DataFrame, dataset: str) -> str:
    """A3: the folder of the frozen split of ``t``, made when these rows have none yet."""
    from ringwatch.session import shared_dir
    from ringwatch.sources.manifest import build_manifest, store_once

    spark = t.sparkSession
    folder = shared_dir(spark, "frozen-splits", f"{data_key(t, 'timestamp', 'is_laundering')}-{TAIL_CUTOFF:%Y%m%d%H%M}-"
                        + "-".join(map(str, SPLIT_FRACTIONS)))
    if not _stored(spark, folder):
        store_once(build_manifest(t, dataset, TAIL_CUTOFF, SPLIT_FRACTIONS), folder)
    return folder


def _stored(spark: SparkSession, folder: str) -> bool:
    from ringwatch.sources.manifest import verify_manifest
    try:
        verify_manifest(spark, folder)
    except FileNotFoundError:
        return False
    return True


def frozen_split(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    """A3 + A4: freeze the split of these rows once into a checksummed manifest in the
    session's shared folder, then read the boundaries back. The folder is named after
    the rows themselves, so changed data gets a new manifest."""
    from ringwatch.sources.manifest import frozen_boundaries

    return frozen_boundaries(spark, freeze(T(spark, sf_dir), f"{sf_dir}/events.parquet"))


def load_split(spark: SparkSession, sf_dir: str, name: str, boundaries=None, rings: bool = True) -> DataFrame:
    """A5: tail cut, one split as a range filter, ring ids attached (C1) unless ``rings`` is false."""
    from ringwatch.operators.joins import attach_pattern_ids
    from ringwatch.operators.split import select_split, truncate_tail
    from ringwatch.plans.q_ingest import rings_with_copies

    if name not in ("train", "validation", "test"):
        raise ValueError(f"unknown split: {name}")
    b = boundaries or frozen_split(spark, sf_dir)
    start, end = split_range(name, b)
    t = truncate_tail(T(spark, sf_dir, start, min(end or TAIL_CUTOFF, TAIL_CUTOFF)), TAIL_CUTOFF)
    rows = select_split(t, name, b)
    return attach_pattern_ids(rows, rings_with_copies(spark, sf_dir)) if rings else rows


HOT_ACCOUNT = "A000000"


def T_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T with a third of all transfers (txn_id % 3 = 0) sent by one hot payer:
    the skew case every plan must survive."""
    t = T(spark, sf_dir)
    return t.withColumn("from_account", F.when(F.col("txn_id") % 3 == 0, F.lit(HOT_ACCOUNT))
                        .otherwise(F.col("from_account")))


SQL_T_SKEWED = f"""ts_ AS (SELECT * REPLACE (CASE WHEN txn_id % 3 = 0 THEN '{HOT_ACCOUNT}' ELSE from_account END
                                   AS from_account) FROM T)"""
