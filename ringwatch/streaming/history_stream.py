"""Account-history features over a stream of transfers (Structured Streaming).

Transfers arrive as Parquet files. Each micro-batch runs the batch plan of
:mod:`ringwatch.operators.history` on its rows, opened with what earlier batches
left behind, so a hot account is spread over tasks exactly as in the batch job
and no row passes through Python. The state is four tables, one version per
micro-batch, in the shared output folder:

* ``sent`` / ``received``: totals per (account, minute), sends of the last 24
  hours by the minute, everything older added up in one row per account;
* ``met``: one row per (payer, payee) that first met in the micro-batch; together the pairs that have met;
* ``marks``: per account the latest (timestamp, txn_id) applied.

Lateness is decided once per transfer: one that lies behind the mark of either of
its accounts can't be applied without rewriting answers already given, so it
goes to the ``late`` table, whole, and touches neither account. Every arriving
transfer is in exactly one of ``decisions`` and ``late``.

All tables of a micro-batch are written under its epoch with overwrite, and a
batch reads only versions of earlier epochs (``met``: of all, the others: of the one before),
so a retried batch replaces its own output. (No ``withWatermark``: Spark would drop late rows.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwatch.functions.money import unit_part, whole_part
from ringwatch.operators.history import (HISTORY_FEATURES, VELOCITY_SECONDS, Opening, build_account_history_features,
                                         first_meetings)
from ringwatch.sources.transfers import epoch_seconds

_TOTALS = "account string, timestamp timestamp_ntz, n bigint, w bigint, u bigint, p bigint"
STATE = {"sent": _TOTALS, "received": _TOTALS, "pairs": "from_account string, to_account string",
         "marks": "account string, timestamp timestamp_ntz, txn_id bigint"}


def _state(spark: SparkSession, out_path: str, epoch: int) -> dict[str, DataFrame]:
    """The state tables after ``epoch`` (empty before the first batch)."""
    if epoch < 0:
        return {name: spark.createDataFrame([], schema) for name, schema in STATE.items()}
    paths = {name: [f"{out_path}/state/{name}/epoch={epoch}"] for name in STATE}
    paths["pairs"] = [f"{out_path}/met/epoch={e}" for e in range(epoch + 1)]
    return {name: spark.read.schema(schema).parquet(*paths[name]) for name, schema in STATE.items()}


def _store(df: DataFrame, out_path: str, name: str, epoch: int) -> DataFrame:
    path = f"{out_path}/{name}/epoch={epoch}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark_late(batch: DataFrame, marks: DataFrame) -> DataFrame:
    """``batch`` with ``_late``: a transfer behind the mark of its payer or payee is late, as a whole."""
    here = F.struct(F.col("timestamp"), F.col("txn_id"))
    for side in ("from_account", "to_account"):
        m = marks.select(F.col("account").alias(side), F.struct("timestamp", "txn_id").alias(f"_mark_{side}"))
        batch = batch.join(m, side, "left")
    late = F.coalesce(here < F.col("_mark_from_account"), F.lit(False)) | F.coalesce(here < F.col("_mark_to_account"), F.lit(False))
    keep = [c for c in batch.columns if not c.startswith("_mark_")]
    return batch.select(*keep, late.alias("_late"))


def _totals(rows: DataFrame, acct: str, met: DataFrame, carried: DataFrame, keep_day: bool) -> DataFrame:
    """State totals after the batch; minutes older than a day before the newest are added up per account."""
    new = (rows.select(F.col(acct).alias("account"), "timestamp", F.lit(1).alias("n"), whole_part("amount_paid").alias("w"),
                       unit_part("amount_paid").alias("u"), F.lit(0).alias("p"))
           .unionByName(met.select(
               F.col(acct).alias("account"), "timestamp", F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("w"),
               F.lit(0).cast("bigint").alias("u"), F.lit(1).alias("p"))))
    both = new.unionByName(carried)
    group = ["account"]
    if keep_day:
        newest = both.agg(F.max(epoch_seconds("timestamp")).alias("_newest"))
        both = both.join(F.broadcast(newest)).withColumn(  # one row
            "_minute", F.when(epoch_seconds("timestamp") > F.col("_newest") - VELOCITY_SECONDS, F.col("timestamp")))
        group = ["account", "_minute"]
    return (both.groupBy(*group).agg(F.max("timestamp").alias("timestamp"), *[F.sum(c).cast("bigint").alias(c) for c in "nwup"])
            .select("account", "timestamp", "n", "w", "u", "p"))


def apply_batch(batch: DataFrame, out_path: str, epoch: int, scorer=None) -> None:
    """One micro-batch: late rows out, decisions stored, state carried on."""
    spark = batch.sparkSession
    state = _state(spark, out_path, epoch - 1)
    marked = _store(mark_late(batch, state["marks"]), out_path, "marked", epoch)
    _store(marked.filter("_late").drop("_late"), out_path, "late", epoch)
    rows = marked.filter("NOT _late").drop("_late")
    opening = Opening(state["sent"], state["received"], state["pairs"])
    met = _store(first_meetings(rows, "from_account", "to_account", opening), out_path, "met", epoch)
    decisions = build_account_history_features(rows, None, opening=opening, met=met).select("txn_id", "amount_paid", *HISTORY_FEATURES)
    _store(scorer(decisions) if scorer is not None else decisions, out_path, "decisions", epoch)
    _store(_totals(rows, "from_account", met, state["sent"], True), out_path, "state/sent", epoch)
    _store(_totals(rows, "to_account", met, state["received"], False), out_path, "state/received", epoch)
    seen = rows.select(F.explode(F.array("from_account", "to_account")).alias("account"), "timestamp", "txn_id").unionByName(state["marks"])
    mark = seen.groupBy("account").agg(F.max(F.struct("timestamp", "txn_id")).alias("m"))
    _store(mark.select("account", "m.timestamp", "m.txn_id"), out_path, "state/marks", epoch)


def run_stream(spark: SparkSession, source: str, schema: T.StructType, out_path: str, checkpoint: str,
               files_per_trigger: int | None = None, scorer=None) -> None:
    """Run the stream over every new file under ``source`` until caught up.

    Each micro-batch writes ``decisions`` (one row per transfer on time: E1-E9, the
    amount and, with ``scorer``, a function adding a ``score`` column, the score)
    and ``late`` (whole transfers behind a mark of their accounts)."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    q = (reader.parquet(source).writeStream.foreachBatch(lambda batch, epoch: apply_batch(batch, out_path, epoch, scorer))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def assemble_features(spark: SparkSession, out_path: str) -> DataFrame:
    """All stored decisions: ``txn_id``, E1-E9 (and ``amount_paid``, ``score`` when present)."""
    return spark.read.parquet(f"{out_path}/decisions").drop("epoch")


def late_transfers(spark: SparkSession, out_path: str) -> DataFrame:
    """All transfers that came too late, as they arrived."""
    return spark.read.parquet(f"{out_path}/late").drop("epoch")
