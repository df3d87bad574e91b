"""Point-in-time account-history features (the flagship job).

Every value for a transfer is computed from the same account's *earlier*
transfers only, in the total order (timestamp, txn_id); rows at or after
``as_of`` are removed before anything is computed.

One plan for every size, safe for an account with any share of the rows:

* Rows fall into buckets (account, minute, txn_id block). Running values inside
  a bucket come from a window over the bucket, so no task holds more than one
  minute x ``id_block`` rows of one account.
* Bucket totals are pre-aggregated (map-side combined). Offsets of a bucket
  inside its minute come from a window over (account, minute), whose rows are
  the minute's blocks.
* Minute totals add the blocks up, so that table has one row per account and
  minute, bounded by the time span whatever the number of rows or input
  partitions. The only windows over a whole account run on it: prefix sums,
  the previous send time, and the 24-hour velocity count (a RANGE frame).
* Distinct-partner counts use one "first seen" event per (account, partner)
  pair, found by an aggregate instead of a window over the pair.

Bucket and minute tables are joined back on the bucket key, by which the rows
are already partitioned.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.functions.money import to_amount, unit_part, whole_part
from ringwatch.sources.transfers import epoch_seconds, ntz_lit, seconds_between

VELOCITY_SECONDS = 24 * 3600
ID_BLOCK = 1 << 17

# Output column names.
SENDER_FEATURES = ("sender_n_sent_before", "sender_amount_sent_before",
                   "sender_distinct_out_before", "sender_seconds_since_last_send")
RECEIVER_FEATURES = ("receiver_n_received_before", "receiver_amount_received_before",
                     "receiver_distinct_in_before")
HISTORY_FEATURES = SENDER_FEATURES + RECEIVER_FEATURES + ("sender_sent_last_24h", "in_out_ratio_before")

_UNB = Window.unboundedPreceding
#: What is summed per row: rows, whole units and fractional units paid, first meetings.
_SUMS = ("n", "w", "u", "p")


def cut_as_of(df: DataFrame, as_of: dt.datetime | None) -> DataFrame:
    """Drop rows at or after ``as_of`` (strict)."""
    if as_of is None:
        return df
    return df.filter(F.col("timestamp") < ntz_lit(as_of))


@dataclass(frozen=True)
class Opening:
    """What earlier transfers left behind, for rows that continue a history.

    ``sent`` / ``received``: ``(account, timestamp, n, w, u, p)``, totals of an account at minutes
    (rows, whole and fractional units paid, first meetings); older minutes may be added up at
    their latest one, as long as sends of the last 24 hours keep their own minutes.
    ``pairs``: ``(from_account, to_account)`` that have met.
    """

    sent: DataFrame
    received: DataFrame
    pairs: DataFrame


def build_account_history_features(df: DataFrame, as_of: dt.datetime | None, id_block: int = ID_BLOCK,
                                   opening: Opening | None = None, met: DataFrame | None = None) -> DataFrame:
    """Append E1-E9 to every transfer strictly before ``as_of``. With ``opening``, everything in it
    counts as earlier than the rows of ``df``. ``met``: the ``first_meetings`` of these rows, where the caller has them."""
    df = cut_as_of(df, as_of)
    cols = df.columns
    rows = df.withColumns({"_w": whole_part("amount_paid"), "_u": unit_part("amount_paid"), "_sb": _block(id_block)})
    base = rows.select("txn_id", "timestamp", "from_account", "to_account", "_w", "_u", "_sb")
    s = _side(rows, base, "from_account", "to_account", SENDER_FEATURES[:3], True, id_block, opening, met)
    r = _side(s, base, "to_account", "from_account", RECEIVER_FEATURES, False, id_block, opening, met)
    e1, e5 = F.col("sender_n_sent_before"), F.col("receiver_n_received_before")
    return r.select(*cols, *SENDER_FEATURES, *RECEIVER_FEATURES,
                    (e1 - F.col("_le24")).alias("sender_sent_last_24h"),
                    ((e5 + 1).cast("double") / (e1 + 1).cast("double")).alias("in_out_ratio_before"))


def _block(id_block: int) -> Column:
    """txn_id block number (integer division keeps the order of ids)."""
    return F.expr(f"txn_id div {int(id_block)}").cast("bigint")


def _z(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


def first_meetings(base: DataFrame, acct: str, other: str, opening: Opening | None = None) -> DataFrame:
    """One row per (account, partner) pair at its first transfer, via an aggregate; pairs that met earlier are out."""
    first = F.min(F.struct("timestamp", "txn_id")).alias("_f")
    met = base.groupBy(acct, other).agg(first)
    if opening is not None:
        met = met.join(opening.pairs, [acct, other], "left_anti")
    return met.select(acct, other, F.col("_f.timestamp").alias("timestamp"), F.col("_f.txn_id").alias("txn_id"))


def _bucket_offsets(base: DataFrame, events: DataFrame, acct: str, sender: bool, carried: DataFrame | None) -> DataFrame:
    """Per bucket, totals of everything strictly before it in its account. ``carried`` minutes
    come before any block of the same minute."""
    key = [acct, "timestamp", "_sb"]
    u = (base.select(*key, F.lit(1).alias("_n"), "_w", "_u", F.lit(0).alias("_p"))
         .unionByName(events.select(*key, F.lit(0).alias("_n"), F.lit(0).cast("bigint").alias("_w"),
                                    F.lit(0).cast("bigint").alias("_u"), F.lit(1).alias("_p"))))
    blocks = u.groupBy(*key).agg(*[F.sum(f"_{c}").alias(f"_b{c}") for c in _SUMS])
    if carried is not None:
        blocks = blocks.unionByName(carried.select(F.col("account").alias(acct), "timestamp", F.lit(-1).cast("bigint").alias("_sb"),
                                                   *[F.col(c).cast("bigint").alias(f"_b{c}") for c in _SUMS]))
    minutes = blocks.groupBy(acct, "timestamp").agg(*[F.sum(f"_b{c}").alias(f"_m{c}") for c in _SUMS])
    before = Window.partitionBy(acct).orderBy("timestamp").rowsBetween(_UNB, -1)
    out = [_z(F.sum(f"_m{c}").over(before)).alias(f"_m{c}0") for c in _SUMS]
    if sender:
        minutes = minutes.withColumn("_ts_s", epoch_seconds("timestamp"))
        by_time = Window.partitionBy(acct).orderBy("_ts_s")
        # A minute's row may hold first meetings only if it holds sends, so every row here is a send time.
        out += [_z(F.sum("_mn").over(by_time.rangeBetween(_UNB, -VELOCITY_SECONDS))).alias("_le24"),
                F.max("timestamp").over(by_time.rangeBetween(_UNB, -1)).alias("_prev_ts")]
    minutes = minutes.select(acct, "timestamp", *out)
    inside = Window.partitionBy(acct, "timestamp").orderBy("_sb").rowsBetween(_UNB, -1)
    blocks = blocks.select(*key, *[_z(F.sum(f"_b{c}").over(inside)).alias(f"_s{c}0") for c in _SUMS])
    extra = ["_le24", "_prev_ts"] if sender else []
    return blocks.join(minutes, [acct, "timestamp"]).select(
        *key, *[(F.col(f"_m{c}0") + F.col(f"_s{c}0")).alias(f"_{c}0") for c in _SUMS],
        F.col("_sn0").alias("_same0"), *extra)


def _side(rows: DataFrame, base: DataFrame, acct: str, other: str, names: tuple[str, ...], sender: bool,
          id_block: int, opening: Opening | None, met: DataFrame | None) -> DataFrame:
    n, amt, dist = names
    key = [acct, "timestamp", "_sb"]
    events = (first_meetings(base, acct, other, opening) if met is None else met).select(acct, "timestamp", "txn_id").withColumn(
        "_sb", _block(id_block))
    carried = None if opening is None else opening.sent if sender else opening.received
    offsets = _bucket_offsets(base, events, acct, sender, carried)
    cols = rows.columns
    u = (rows.withColumn("_kind", F.lit(0))
         .unionByName(events.withColumn("_kind", F.lit(1)), allowMissingColumns=True))
    # Rows before events on equal txn_id: a pair's own first transfer does
    # not count itself as a known partner.
    inner = Window.partitionBy(*key).orderBy("txn_id", "_kind").rowsBetween(_UNB, -1)
    u = u.select("*", _z(F.sum(1 - F.col("_kind")).over(inner)).alias("_n1"), _z(F.sum("_w").over(inner)).alias("_w1"),
                 _z(F.sum("_u").over(inner)).alias("_u1"), _z(F.sum("_kind").over(inner)).alias("_p1"))
    j = u.filter(F.col("_kind") == 0).join(offsets, key)
    out = [(F.col("_n0") + F.col("_n1")).alias(n),
           to_amount(F.col("_w0") + F.col("_w1"), F.col("_u0") + F.col("_u1")).alias(amt),
           (F.col("_p0") + F.col("_p1")).alias(dist)]
    if sender:
        out += [F.when(F.col("_same0") + F.col("_n1") > 0, F.lit(0).cast("bigint"))
                .otherwise(seconds_between("_prev_ts", "timestamp")).alias("sender_seconds_since_last_send"),
                F.col("_le24")]
    return j.select(*cols, *out)
