"""Registered queries: degrees (D6, D7, L2) and documented analyses (L1, L3-L8), ring parsing (A2)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.graph_stats import degree_percentiles, degree_summary, degree_table
from ringwatch.operators.history import build_account_history_features
from ringwatch.operators.joins import attach_pattern_ids
from ringwatch.operators.reports import (daily_rate, feature_by_class, format_share, label_coverage,
                                         pattern_shapes, ring_shape, top_senders)
from ringwatch.plans.catalog import register
from ringwatch.plans.common import AS_OF, SQL_AS_OF, T, T_with_pattern, round_doubles
from ringwatch.plans.q_ingest import _RINGS_SQL, rings_with_copies
from ringwatch.session import ensure_checkpoint_dir
from ringwatch.sources.patterns import PATTERN_TYPES, parse_patterns, rings_from_transfers, write_patterns_text

_ROLES_SQL = "r AS (SELECT from_account AS account, 0 AS role FROM T UNION ALL SELECT to_account, 1 FROM T)"
_DEG_SQL = f"""WITH {_ROLES_SQL},
d AS (SELECT account, CAST(sum(CASE WHEN role = 0 THEN 1 ELSE 0 END) AS BIGINT) AS out_degree,
        CAST(sum(role) AS BIGINT) AS in_degree, CAST(count(*) AS BIGINT) AS degree FROM r GROUP BY account)"""


def _nearest_sql(q: float) -> str:
    return f"max(CASE WHEN rn = CAST(floor((n - 1) * CAST({q!r} AS DOUBLE) + 0.5) AS BIGINT) + 1 THEN degree END)"


@register("q_degree_table", _DEG_SQL + "\nSELECT * FROM d")
def q_degree_table(spark, sf_dir):
    return degree_table(T(spark, sf_dir))


@register("q_degree_summary", _DEG_SQL + f""",
rk AS (SELECT degree, row_number() OVER (ORDER BY degree) AS rn, count(*) OVER () AS n FROM d)
SELECT (SELECT count(*) FROM d) AS n_accounts, (SELECT CAST(sum(out_degree) AS BIGINT) FROM d) AS n_edges,
  (SELECT round(avg(degree), 6) FROM d) AS mean_degree, (SELECT round(median(degree), 6) FROM d) AS median_degree,
  (SELECT max(out_degree) FROM d) AS max_out_degree, (SELECT max(in_degree) FROM d) AS max_in_degree,
  CAST({_nearest_sql(0.99)} AS DOUBLE) AS p99_degree FROM rk""")
def q_degree_summary(spark, sf_dir):
    return round_doubles(degree_summary(T(spark, sf_dir)))


@register("q_degree_percentiles", _DEG_SQL + f""",
rk AS (SELECT degree, row_number() OVER (ORDER BY degree) AS rn, count(*) OVER () AS n FROM d)
SELECT {_nearest_sql(0.5)} AS p50, {_nearest_sql(0.75)} AS p75, {_nearest_sql(0.9)} AS p90,
  {_nearest_sql(0.99)} AS p99, max(degree) AS max FROM rk""")
def q_degree_percentiles(spark, sf_dir):
    return degree_percentiles(T(spark, sf_dir))


@register("q_daily_rate", """
WITH d AS (SELECT CAST(timestamp AS DATE) AS day, count(*) AS transactions,
             CAST(sum(is_laundering) AS BIGINT) AS laundering FROM T GROUP BY 1),
o AS (SELECT sum(laundering) / sum(transactions) AS overall FROM d)
SELECT strftime(day, '%Y-%m-%d') AS day, transactions, laundering, round(laundering / transactions, 6) AS laundering_rate,
  CAST(laundering / transactions > 10.0 * overall AS INTEGER) AS flagged FROM d, o""")
def q_daily_rate(spark, sf_dir):
    d = daily_rate(T(spark, sf_dir))
    return round_doubles(d.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


@register("q_top_senders", """
SELECT from_account, count(*) AS sent, CAST(sum(is_laundering) AS BIGINT) AS laundering,
  round(sum(is_laundering) / count(*), 6) AS laundering_rate
FROM T GROUP BY from_account ORDER BY sent DESC, from_account LIMIT 10""")
def q_top_senders(spark, sf_dir):
    return round_doubles(top_senders(T(spark, sf_dir), 10))


_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in PATTERN_TYPES) + "]"
_RING_TABLE_SQL = f"""rt AS (
  SELECT timestamp, from_account, to_account, pattern_id, {_TYPES_SQL}[pattern_id % 8 + 1] AS pattern_type
  FROM T WHERE pattern_id >= 0)"""


def _rings(spark, sf_dir):
    return rings_from_transfers(T_with_pattern(spark, sf_dir))


@register("q_pattern_shapes", f"""WITH {_RING_TABLE_SQL},
per AS (SELECT pattern_type, pattern_id, count(*) AS n FROM rt GROUP BY ALL)
SELECT pattern_type, count(*) AS attempts, CAST(sum(n) AS BIGINT) AS transfers, round(sum(n) / count(*), 6) AS avg_transfers
FROM per GROUP BY pattern_type""")
def q_pattern_shapes(spark, sf_dir):
    return round_doubles(pattern_shapes(_rings(spark, sf_dir)))


@register("q_ring_shape", f"""WITH {_RING_TABLE_SQL},
acc AS (SELECT pattern_id, count(DISTINCT a) AS accounts FROM (
          SELECT pattern_id, from_account AS a FROM rt UNION ALL SELECT pattern_id, to_account FROM rt) GROUP BY 1),
per AS (SELECT pattern_id, count(*) AS transfers,
          date_diff('second', min(timestamp), max(timestamp)) / 86400.0 AS days FROM rt GROUP BY 1),
s AS (SELECT * FROM per JOIN acc USING (pattern_id))
SELECT round(CAST(max(transfers) AS DOUBLE), 6) AS max_transfers, round(CAST(max(accounts) AS DOUBLE), 6) AS max_accounts,
  round(max(days), 6) AS max_days, round(median(transfers), 6) AS median_transfers,
  round(median(accounts), 6) AS median_accounts, round(median(days), 6) AS median_days FROM s""")
def q_ring_shape(spark, sf_dir):
    return round_doubles(ring_shape(_rings(spark, sf_dir)))


@register("q_label_coverage", f"""WITH {_RINGS_SQL},
w AS (SELECT t.is_laundering, coalesce(l.pattern_id, -1) AS pattern_id
      FROM T t LEFT JOIN lookup l USING (timestamp, from_account, to_account, amount_paid)),
a AS (SELECT CAST(sum(CASE WHEN is_laundering = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives,
        CAST(sum(CASE WHEN is_laundering = 1 AND pattern_id <> -1 THEN 1 ELSE 0 END) AS BIGINT) AS positives_in_ring,
        CAST(sum(CASE WHEN pattern_id <> -1 THEN 1 ELSE 0 END) AS BIGINT) AS ring_transfers FROM w)
SELECT *, round(positives_in_ring / positives, 6) AS share_in_ring,
  round(1.0 - positives_in_ring / positives, 6) AS share_outside FROM a""")
def q_label_coverage(spark, sf_dir):
    w = attach_pattern_ids(T(spark, sf_dir), rings_with_copies(spark, sf_dir))
    return round_doubles(label_coverage(w))


@register("q_feature_by_class", f"""
WITH f AS (SELECT is_laundering, amount_paid,
    CAST(receiving_currency <> payment_currency AS INTEGER) AS is_cross_currency,
    CAST(from_account = to_account AS INTEGER) AS is_self_transfer,
    CAST(from_bank = to_bank AS INTEGER) AS is_same_bank,
    row_number() OVER (PARTITION BY from_account ORDER BY timestamp, txn_id) - 1 AS sender_n_sent_before,
    row_number() OVER (PARTITION BY to_account ORDER BY timestamp, txn_id) - 1 AS receiver_n_received_before,
    (row_number() OVER (PARTITION BY from_account ORDER BY timestamp, txn_id) - 1)
      - count(*) OVER (PARTITION BY from_account ORDER BY timestamp
          RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 24 HOURS PRECEDING) AS sender_sent_last_24h
  FROM T WHERE timestamp < {SQL_AS_OF})
SELECT is_laundering, count(*) AS rows,
  round(avg(is_cross_currency), 6) AS rate_is_cross_currency, round(avg(is_self_transfer), 6) AS rate_is_self_transfer,
  round(avg(is_same_bank), 6) AS rate_is_same_bank,
  round(median(amount_paid), 6) AS median_amount_paid,
  round(median(sender_n_sent_before), 6) AS median_sender_n_sent_before,
  round(median(receiver_n_received_before), 6) AS median_receiver_n_received_before,
  round(median(sender_sent_last_24h), 6) AS median_sender_sent_last_24h
FROM f GROUP BY is_laundering""")
def q_feature_by_class(spark, sf_dir):
    feats = build_account_history_features(build_basic_features(T(spark, sf_dir, end=AS_OF)), AS_OF)
    # The rank selection reads the features twice (sketches, counts inside the
    # brackets): materialise the feature table once in the shared checkpoint folder.
    ensure_checkpoint_dir(spark)
    feats = feats.select("is_laundering", "amount_paid", "sender_n_sent_before", "receiver_n_received_before",
                         "sender_sent_last_24h", "is_cross_currency", "is_self_transfer",
                         "is_same_bank").checkpoint(eager=True)
    return round_doubles(feature_by_class(feats))


@register("q_format_share", """
WITH g AS (SELECT payment_format, count(*) AS rows, CAST(sum(is_laundering) AS BIGINT) AS positives FROM T GROUP BY 1)
SELECT payment_format, rows, positives, round(positives / rows, 6) AS rate,
  round(rows / sum(rows) OVER (), 6) AS share_rows, round(positives / sum(positives) OVER (), 6) AS share_positives
FROM g""")
def q_format_share(spark, sf_dir):
    return round_doubles(format_share(T(spark, sf_dir)))


@register("q_parse_patterns", f"""WITH {_RING_TABLE_SQL},
h AS (SELECT *, row_number() OVER (PARTITION BY pattern_id ORDER BY timestamp, txn_id) - 1 AS hop FROM (
        SELECT t.*, {_TYPES_SQL}[t.pattern_id % 8 + 1] AS pattern_type FROM T t WHERE pattern_id >= 0))
SELECT CAST(dense_rank() OVER (ORDER BY pattern_id) - 1 AS INTEGER) AS pattern_id, pattern_type,
  CAST(hop AS INTEGER) AS hop, from_account, to_account, round(amount_paid, 6) AS amount_paid,
  strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp
FROM h""")
def q_parse_patterns(spark, sf_dir):
    """A2 round trip: ring blocks rendered from T are written as text under the
    session's checkpoint folder, then parsed back with the distributed parser."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"rings-{uuid.uuid4().hex}")
    write_patterns_text(_rings(spark, sf_dir), path)
    p = parse_patterns(spark, path)
    return round_doubles(p.select("pattern_id", "pattern_type", "hop", "from_account", "to_account", "amount_paid",
                                  F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")))
