"""Registered queries: row features (B1-B7) and account history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringwatch.functions.basic import BASIC_FEATURES, build_basic_features
from ringwatch.functions.money import duckdb_sum
from ringwatch.operators.history import HISTORY_FEATURES, ID_BLOCK, build_account_history_features
from ringwatch.plans.catalog import register
from ringwatch.plans.common import AS_OF, SQL_AS_OF, SQL_T_SKEWED, T, T_skewed, round_doubles


_BASIC_SQL = """
SELECT txn_id,
  CAST(hour(timestamp) AS INTEGER) AS hour,
  CAST(isodow(timestamp) AS INTEGER) AS weekday,
  round(ln(1 + amount_paid), 6) AS log_amount,
  round(CASE WHEN amount_paid > 0 THEN amount_received / amount_paid ELSE 1.0 END, 6) AS amount_ratio,
  CAST(receiving_currency <> payment_currency AS INTEGER) AS is_cross_currency,
  CAST(from_account = to_account AS INTEGER) AS is_self_transfer,
  CAST(from_bank = to_bank AS INTEGER) AS is_same_bank
FROM T
"""


@register("q_basic_features", _BASIC_SQL)
def q_basic_features(spark, sf_dir):
    df = build_basic_features(T(spark, sf_dir))
    return round_doubles(df.select("txn_id", *BASIC_FEATURES))


def history_ctes(as_of_sql: str = SQL_AS_OF, source: str = "T") -> str:
    """CTEs ending in ``hist(txn_id, <E1-E9 unrounded>)`` for rows of ``source`` before ``as_of_sql``."""
    return f"""base AS (
  SELECT txn_id, timestamp, from_account, to_account, {duckdb_sum('amount_paid')} AS paid
  FROM {source} WHERE timestamp < {as_of_sql}),
f AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY from_account, to_account ORDER BY timestamp, txn_id) = 1 AS INTEGER) AS new_out,
    CAST(row_number() OVER (PARTITION BY to_account, from_account ORDER BY timestamp, txn_id) = 1 AS INTEGER) AS new_in
  FROM base),
g AS (
  SELECT txn_id,
    CAST(row_number() OVER (PARTITION BY from_account ORDER BY timestamp, txn_id) - 1 AS BIGINT) AS e1,
    coalesce(sum(paid) OVER (PARTITION BY from_account ORDER BY timestamp, txn_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e2s,
    coalesce(sum(new_out) OVER (PARTITION BY from_account ORDER BY timestamp, txn_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e3,
    date_diff('second', lag(timestamp) OVER (PARTITION BY from_account ORDER BY timestamp, txn_id), timestamp) AS e4,
    CAST(row_number() OVER (PARTITION BY to_account ORDER BY timestamp, txn_id) - 1 AS BIGINT) AS e5,
    coalesce(sum(paid) OVER (PARTITION BY to_account ORDER BY timestamp, txn_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e6s,
    coalesce(sum(new_in) OVER (PARTITION BY to_account ORDER BY timestamp, txn_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e7,
    count(*) OVER (PARTITION BY from_account ORDER BY timestamp
                   RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 24 HOURS PRECEDING) AS le24
  FROM f),
hist AS (
  SELECT txn_id,
    e1 AS sender_n_sent_before,
    CAST(e2s AS DOUBLE) AS sender_amount_sent_before,
    CAST(e3 AS BIGINT) AS sender_distinct_out_before,
    CAST(e4 AS BIGINT) AS sender_seconds_since_last_send,
    e5 AS receiver_n_received_before,
    CAST(e6s AS DOUBLE) AS receiver_amount_received_before,
    CAST(e7 AS BIGINT) AS receiver_distinct_in_before,
    CAST(e1 - le24 AS BIGINT) AS sender_sent_last_24h,
    CAST(e5 + 1 AS DOUBLE) / CAST(e1 + 1 AS DOUBLE) AS in_out_ratio_before
  FROM g)"""


def history_sql(source_ctes: str = "", source: str = "T", digits: int = 6) -> str:
    prefix = f"{source_ctes}, " if source_ctes else ""
    return f"""WITH {prefix}{history_ctes(source=source)}
SELECT txn_id, sender_n_sent_before, round(sender_amount_sent_before, {digits}) AS sender_amount_sent_before,
  sender_distinct_out_before, sender_seconds_since_last_send, receiver_n_received_before,
  round(receiver_amount_received_before, {digits}) AS receiver_amount_received_before, receiver_distinct_in_before,
  sender_sent_last_24h, round(in_out_ratio_before, {digits}) AS in_out_ratio_before
FROM hist"""


_HISTORY_SQL = history_sql()


def _history(spark, sf_dir, source=None, id_block=ID_BLOCK):
    t = source(spark, sf_dir) if source else T(spark, sf_dir, end=AS_OF)
    df = build_account_history_features(t, AS_OF, id_block)
    return round_doubles(df.select("txn_id", *HISTORY_FEATURES))


@register("q_account_history", _HISTORY_SQL)
def q_account_history(spark, sf_dir):
    """Flagship."""
    return _history(spark, sf_dir)


@register("q_account_history_bucketed", _HISTORY_SQL)
def q_account_history_bucketed(spark, sf_dir):
    """The same plan with ids cut into many blocks, as many input partitions would."""
    return _history(spark, sf_dir, id_block=64)


@register("q_account_history_plain", _HISTORY_SQL)
def q_account_history_plain(spark, sf_dir):
    """The same plan with one block: buckets are (account, minute)."""
    return _history(spark, sf_dir, id_block=1 << 62)


@register("q_account_history_skewed", history_sql(SQL_T_SKEWED, "ts_"))
def q_account_history_skewed(spark, sf_dir):
    """One payer holds a third of all rows, ids scattered over blocks: the account
    is spread over (minute, id block) buckets, its window runs over minutes."""
    return _history(spark, sf_dir, T_skewed, id_block=64)


def T_small_change(spark, sf_dir):
    """T with sub-cent amounts: every row's amount in 10^-6 units plus a few satoshi."""
    t = T(spark, sf_dir, end=AS_OF)
    return t.withColumn("amount_paid", F.round(F.col("amount_paid") / 1_000_000 + (F.col("txn_id") % 7) * 1e-8, 8))


@register("q_account_history_small_change", history_sql("""sc_ AS (SELECT * REPLACE (
  round(amount_paid / 1000000 + (txn_id % 7) * 1e-8, 8) AS amount_paid) FROM T)""", "sc_", 8))
def q_account_history_small_change(spark, sf_dir):
    """E2 and E6 stay exact for amounts far below a cent."""
    df = build_account_history_features(T_small_change(spark, sf_dir), AS_OF)
    return round_doubles(df.select("txn_id", *HISTORY_FEATURES), 8)
