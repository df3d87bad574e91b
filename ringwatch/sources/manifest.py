"""Freeze a temporal split; read it back; check it.

The frozen split is a one-row table in a shared folder: the manifest as JSON,
built by Spark from the per-split statistics, and its SHA-256. A table appears
under its name only when complete (written aside, then renamed), so of several
writers one wins and readers never see half a table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.operators.split import compute_boundaries, split_stats, tail_rows_dropped, truncate_tail

ISO = "yyyy-MM-dd'T'HH:mm:ss"
MANIFEST_SCHEMA = "manifest string, sha256 string"


def split_manifest_frame(df: DataFrame, tail_cutoff: dt.datetime, fractions=(0.6, 0.2),
                         boundaries: tuple[dt.datetime, dt.datetime] | None = None) -> DataFrame:
    """One row per split with boundaries and tail count attached (the tabular manifest)."""
    dropped = tail_rows_dropped(df, tail_cutoff)
    kept = truncate_tail(df, tail_cutoff)
    b = boundaries or compute_boundaries(kept, fractions)
    if b[0] is None:
        raise ValueError("no rows before the tail cutoff")
    stats = split_stats(kept, b)
    return stats.select(
        "split", "transactions", "laundering", "laundering_rate",
        F.date_format("first", ISO).alias("first"), F.date_format("last", ISO).alias("last"),
        F.lit(b[0].isoformat()).alias("train_end"), F.lit(b[1].isoformat()).alias("val_end"),
        F.lit(dropped).cast("bigint").alias("tail_rows_dropped"))


def build_manifest(df: DataFrame, dataset: str, tail_cutoff: dt.datetime, fractions=(0.6, 0.2),
                   tail_reason: str = "later than the documented period") -> DataFrame:
    """One row ``(manifest, sha256)``: the manifest as JSON and the digest of that text."""
    per_split = split_manifest_frame(df, tail_cutoff, fractions)
    # The manifest's keys.
    one = F.struct("first", "last", "laundering", "laundering_rate", "transactions")
    whole = per_split.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", one)))).alias("splits"),  # three entries
                          F.max("train_end").alias("train_end"), F.max("val_end").alias("val_end"),
                          F.max("tail_rows_dropped").alias("tail_rows_dropped"))
    text = F.to_json(F.struct(
        F.lit(dataset).alias("dataset"), F.lit("cut by time at quantiles of the row order").alias("method"),
        F.struct(F.lit(fractions[0]).alias("train"), F.lit(fractions[1]).alias("validation")).alias("fractions"),
        F.lit(tail_cutoff.isoformat()).alias("tail_cutoff"), "tail_rows_dropped", F.lit(tail_reason).alias("tail_reason"),
        F.struct("train_end", "val_end").alias("boundaries"), "splits"))
    return whole.select(text.alias("manifest")).withColumn("sha256", F.sha2("manifest", 256))


def store_once(df: DataFrame, path: str, write=lambda df, path: df.write.parquet(path)) -> None:
    """Write ``df`` to ``path`` unless a complete table is there; of several writers one wins."""
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        return
    aside = f"{path}-{uuid.uuid4().hex}"
    write(df, aside)
    source = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside)
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, True)


def read_manifest(spark: SparkSession, folder: str):
    """The stored row; ``FileNotFoundError`` if nothing is stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"no frozen split in {folder}")
    row = spark.read.schema(MANIFEST_SCHEMA).parquet(folder).select(
        "*", F.sha2("manifest", 256).alias("actual"), F.get_json_object("manifest", "$.boundaries.train_end").alias("train_end"),
        F.get_json_object("manifest", "$.boundaries.val_end").alias("val_end")).first()
    if row is None or row["sha256"] is None:
        raise FileNotFoundError(f"no recorded checksum in {folder}")
    return row


def frozen_boundaries(spark: SparkSession, folder: str) -> tuple[dt.datetime, dt.datetime]:
    """A4: read the boundaries back instead of recomputing them."""
    row = read_manifest(spark, folder)
    return dt.datetime.fromisoformat(row["train_end"]), dt.datetime.fromisoformat(row["val_end"])


def verify_manifest(spark: SparkSession, folder: str) -> None:
    """The manifest must exist, have a recorded checksum, and match it."""
    row = read_manifest(spark, folder)
    if row["actual"] != row["sha256"]:
        raise ValueError(f"the frozen split in {folder} was changed: its digest is {row['actual']}, recorded was {row['sha256']}")
