"""Registered queries: load, contracts, summary, split."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.contracts import FEATURES, RAW_TRANSACTIONS, violation_counts, write_checked
from ringwatch.operators.history import build_account_history_features
from ringwatch.operators.joins import attach_pattern_ids
from ringwatch.operators.split import assign_split, snapshot_index, time_slice, truncate_tail
from ringwatch.operators.quantiles import quantiles
from ringwatch.operators.summary import accounts_by_period, daily_account_sketches, role_rows, summarise
from ringwatch.plans.catalog import register
from ringwatch.plans.common import (
    AS_OF, SPLIT_FRACTIONS, SQL_AS_OF, SQL_TAIL_CUTOFF, T, TAIL_CUTOFF, T_with_pattern, frozen_split,
    round_doubles)
from ringwatch.session import ensure_checkpoint_dir, shared_dir
from ringwatch.sources.manifest import ISO, split_manifest_frame, store_once
from ringwatch.sources.patterns import rings_from_transfers
from ringwatch.sources.transfers import SOURCE_COLUMNS, TRANSFER_COLUMNS, load_transactions_csv, write_transfers_csv

_T_COLS = ", ".join(TRANSFER_COLUMNS)


@register("q_load", f"SELECT {_T_COLS} FROM T")
def q_load(spark, sf_dir):
    return T(spark, sf_dir)


@register("q_summary", """
WITH r AS (SELECT from_account AS account FROM T UNION ALL SELECT to_account FROM T),
a AS (SELECT count(*) AS n_transactions, min(timestamp) AS date_min, max(timestamp) AS date_max,
             CAST(sum(is_laundering) AS BIGINT) AS n_laundering FROM T)
SELECT n_transactions, (SELECT count(DISTINCT account) FROM r) AS n_accounts,
  strftime(date_min, '%Y-%m-%dT%H:%M:%S') AS date_min, strftime(date_max, '%Y-%m-%dT%H:%M:%S') AS date_max,
  n_laundering,
  round(CASE WHEN n_transactions > 0 THEN n_laundering / n_transactions ELSE 0.0 END, 6) AS laundering_rate,
  CAST(date_sub('day', date_min, date_max) AS BIGINT) AS span_days,
  CASE WHEN n_laundering > 0 THEN CAST(round(n_transactions / n_laundering) AS BIGINT) END AS one_in
FROM a
""")
def q_summary(spark, sf_dir):
    s = summarise(T(spark, sf_dir))
    s = s.withColumn("date_min", F.date_format("date_min", ISO)).withColumn("date_max", F.date_format("date_max", ISO))
    return round_doubles(s)


# Three relative standard errors of a sketch of 2**12 registers: 3 * 1.04 / 64.
SKETCH_BOUND = 0.04875
_PERIOD_SQL = "CAST(date_trunc('week', timestamp) AS DATE)"


@register("q_distinct_by_period", f"""
WITH r AS (SELECT timestamp, from_account AS account FROM T UNION ALL SELECT timestamp, to_account FROM T),
p AS (SELECT strftime({_PERIOD_SQL}, 'week %Y-%m-%d') AS period, account FROM r
      UNION ALL SELECT strftime(timestamp, 'month %Y-%m'), account FROM r UNION ALL SELECT 'all', account FROM r)
SELECT period, CAST(count(*) / 2 AS BIGINT) AS transfers, count(DISTINCT account) AS exact_accounts,
  1 AS within_bound FROM p GROUP BY period""")
def q_distinct_by_period(spark, sf_dir):
    """Distinct accounts of every week, month and of all time from one table of daily sketches, beside the
    exact counts; ``within_bound`` tells whether the estimate is off by at most ``SKETCH_BOUND``."""
    t = T(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    stored = daily_account_sketches(t).checkpoint()

    def periods(day):
        return F.array(F.date_format(F.date_trunc("week", day), "'week' yyyy-MM-dd"),
                       F.date_format(day, "'month' yyyy-MM"), F.lit("all"))

    # A day's sketch goes into each of its three periods; the rows are days, not transfers.
    days = stored.withColumn("_p", F.explode(periods("day")))
    estimate = accounts_by_period(days, F.col("_p"))
    exact = (role_rows(t, ["timestamp"]).select(F.to_date("timestamp").alias("day"), "account").distinct()
             .select(F.explode(periods("day")).alias("period"), "account")
             .groupBy("period").agg(F.countDistinct("account").alias("exact_accounts")))
    off = F.abs(F.col("accounts") - F.col("exact_accounts")) / F.col("exact_accounts")
    return estimate.join(exact, "period").select(
        "period", "transfers", "exact_accounts", (off <= SKETCH_BOUND).cast("int").alias("within_bound"))


def _dirty(spark, sf_dir):
    t = T(spark, sf_dir)
    i = F.col("txn_id")
    return (t.withColumn("amount_paid", F.when(i % 97 == 0, F.lit(-1.0)).otherwise(F.col("amount_paid")))
             .withColumn("is_laundering", F.when(i % 89 == 0, F.lit(2)).otherwise(F.col("is_laundering")))
             .withColumn("from_account", F.when(i % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("from_account")))
             .withColumn("amount_received", F.when(i % 79 == 0, F.lit(float("nan"))).otherwise(F.col("amount_received"))))


def _rule_sql(rules: dict[str, str], source: str) -> str:
    parts = [f"SELECT '{name}' AS rule, CAST(sum(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM {source}"
             for name, pred in rules.items()]
    return "\nUNION ALL\n".join(parts)


_RAW_RULES_SQL = {
    **{f"{c}_null": f"{c} IS NULL" for c in ("timestamp", "from_bank", "from_account", "to_bank", "to_account",
                                             "receiving_currency", "payment_currency", "payment_format",
                                             "amount_received", "amount_paid", "is_laundering")},
    "amount_received_negative": "amount_received < 0", "amount_received_nan": "isnan(amount_received)",
    "amount_paid_negative": "amount_paid < 0", "amount_paid_nan": "isnan(amount_paid)",
    "is_laundering_not_binary": "is_laundering NOT IN (0, 1)",
}

_DIRTY_SQL = """dirty AS (
  SELECT txn_id, timestamp, from_bank,
    CASE WHEN txn_id % 83 = 0 THEN NULL ELSE from_account END AS from_account, to_bank, to_account,
    CASE WHEN txn_id % 79 = 0 THEN 'NaN'::DOUBLE ELSE amount_received END AS amount_received, receiving_currency,
    CASE WHEN txn_id % 97 = 0 THEN -1.0::DOUBLE ELSE amount_paid END AS amount_paid, payment_currency, payment_format,
    CASE WHEN txn_id % 89 = 0 THEN 2 ELSE is_laundering END AS is_laundering
  FROM T)"""


@register("q_contract_raw", f"WITH {_DIRTY_SQL}\n{_rule_sql(_RAW_RULES_SQL, 'dirty')}")
def q_contract_raw(spark, sf_dir):
    assert set(RAW_TRANSACTIONS.rules) == set(_RAW_RULES_SQL)
    return violation_counts(_dirty(spark, sf_dir), RAW_TRANSACTIONS)


def _feature_rules_sql() -> dict[str, str]:
    out = {}
    for name in FEATURES.rules:
        col, _, kind = name.rpartition("_")
        if name.endswith("_null"):
            out[name] = f"{name[:-5]} IS NULL"
        elif name.endswith("_nan"):
            out[name] = f"isnan({name[:-4]})"
        elif name.endswith("_not_binary"):
            out[name] = f"{name[:-11]} NOT IN (0, 1)"
        elif "_below_" in name:
            c, v = name.rsplit("_below_", 1)
            out[name] = f"{c} < {v}"
        elif "_above_" in name:
            c, v = name.rsplit("_above_", 1)
            out[name] = f"{c} > {v}"
    return out


_FEATURE_SQL = f"""
WITH base AS (SELECT * FROM T WHERE timestamp < {SQL_AS_OF}),
firsts AS (SELECT *,
    CAST(row_number() OVER (PARTITION BY from_account, to_account ORDER BY timestamp, txn_id) = 1 AS INTEGER) AS new_out,
    CAST(row_number() OVER (PARTITION BY to_account, from_account ORDER BY timestamp, txn_id) = 1 AS INTEGER) AS new_in
  FROM base),
f AS (
  SELECT txn_id, is_laundering,
    hour(timestamp) AS hour, isodow(timestamp) AS weekday, ln(1 + amount_paid) AS log_amount,
    CASE WHEN amount_paid > 0 THEN amount_received / amount_paid ELSE 1.0 END AS amount_ratio,
    CAST(receiving_currency <> payment_currency AS INTEGER) AS is_cross_currency,
    CAST(from_account = to_account AS INTEGER) AS is_self_transfer,
    CAST(from_bank = to_bank AS INTEGER) AS is_same_bank,
    row_number() OVER (PARTITION BY from_account ORDER BY timestamp, txn_id) - 1 AS sender_n_sent_before,
    coalesce(sum(amount_paid) OVER (PARTITION BY from_account ORDER BY timestamp, txn_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sender_amount_sent_before,
    coalesce(sum(new_out) OVER (PARTITION BY from_account ORDER BY timestamp, txn_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sender_distinct_out_before,
    (row_number() OVER (PARTITION BY from_account ORDER BY timestamp, txn_id) - 1)
      - count(*) OVER (PARTITION BY from_account ORDER BY timestamp
          RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 24 HOURS PRECEDING) AS sender_sent_last_24h,
    row_number() OVER (PARTITION BY to_account ORDER BY timestamp, txn_id) - 1 AS receiver_n_received_before,
    coalesce(sum(amount_paid) OVER (PARTITION BY to_account ORDER BY timestamp, txn_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS receiver_amount_received_before,
    coalesce(sum(new_in) OVER (PARTITION BY to_account ORDER BY timestamp, txn_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS receiver_distinct_in_before
  FROM firsts),
g AS (SELECT *, CAST(receiver_n_received_before + 1 AS DOUBLE) / (sender_n_sent_before + 1) AS in_out_ratio_before FROM f)
{_rule_sql(_feature_rules_sql(), 'g')}
"""


_CHECKED_SQL = f"""WITH {_DIRTY_SQL},
counts AS ({_rule_sql(_RAW_RULES_SQL, 'dirty')})
SELECT * FROM counts
UNION ALL SELECT 'stored_good', CAST(sum(CASE WHEN {' OR '.join(f'coalesce({p}, false)' for p in _RAW_RULES_SQL.values())}
  THEN 0 ELSE 1 END) AS BIGINT) FROM dirty
UNION ALL SELECT 'stored_quarantined', CAST(sum(CASE WHEN {' OR '.join(f'coalesce({p}, false)' for p in _RAW_RULES_SQL.values())}
  THEN 1 ELSE 0 END) AS BIGINT) FROM dirty"""


@register("q_contract_write", _CHECKED_SQL)
def q_contract_write(spark, sf_dir):
    """I1 in the writing pass: rule counts from the job that wrote the table, and what the table then holds."""
    import uuid

    checked = write_checked(_dirty(spark, sf_dir), RAW_TRANSACTIONS, shared_dir(spark, "checked", uuid.uuid4().hex))
    held = checked.good.select(F.lit("stored_good").alias("rule")).unionByName(
        checked.quarantined.select(F.lit("stored_quarantined").alias("rule")))
    held = held.groupBy("rule").agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
    counted = spark.createDataFrame(list(checked.violations.items()), "rule string, violations bigint")
    return counted.unionByName(held)


@register("q_contract_features", _FEATURE_SQL)
def q_contract_features(spark, sf_dir):
    feats = build_account_history_features(build_basic_features(T(spark, sf_dir, end=AS_OF)), AS_OF)
    return violation_counts(feats, FEATURES)


@register("q_truncate_tail", f"SELECT {_T_COLS} FROM T WHERE timestamp < {SQL_TAIL_CUTOFF}")
def q_truncate_tail(spark, sf_dir):
    return truncate_tail(T(spark, sf_dir, end=TAIL_CUTOFF), TAIL_CUTOFF)


def _boundary_sql() -> str:
    q1, q2 = SPLIT_FRACTIONS[0], SPLIT_FRACTIONS[0] + SPLIT_FRACTIONS[1]
    return f"""
WITH c AS (SELECT timestamp FROM T WHERE timestamp < {SQL_TAIL_CUTOFF}),
n AS (SELECT count(*) AS n FROM c),
r AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) AS rn FROM c),
b AS (SELECT
  max(CASE WHEN rn = CAST(floor((n - 1) * CAST({q1!r} AS DOUBLE) + 0.5) AS BIGINT) + 1 THEN timestamp END) AS train_end,
  max(CASE WHEN rn = CAST(floor((n - 1) * CAST({q2!r} AS DOUBLE) + 0.5) AS BIGINT) + 1 THEN timestamp END) AS val_end
  FROM r, n)"""


_BOUNDS_SQL = _boundary_sql()


@register("q_boundaries", _BOUNDS_SQL + """
SELECT strftime(train_end, '%Y-%m-%dT%H:%M:%S') AS train_end, strftime(val_end, '%Y-%m-%dT%H:%M:%S') AS val_end FROM b""")
def q_boundaries(spark, sf_dir):
    """D3 as one lazy plan: counts per instant, distributed running counts, and the
    instant at each "nearest" rank (``compute_boundaries`` returns the same values as
    literals for filters)."""
    q1, q2 = SPLIT_FRACTIONS[0], SPLIT_FRACTIONS[0] + SPLIT_FRACTIONS[1]
    b = quantiles(truncate_tail(T(spark, sf_dir, end=TAIL_CUTOFF), TAIL_CUTOFF), "timestamp",
                  {"train_end": ("nearest", q1), "val_end": ("nearest", q2)})
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return b.select(F.date_format("train_end", iso).alias("train_end"), F.date_format("val_end", iso).alias("val_end"))


@register("q_assign_split", _BOUNDS_SQL + f""",
s AS (SELECT txn_id, CASE WHEN timestamp < train_end THEN 'train' WHEN timestamp < val_end THEN 'validation'
       ELSE 'test' END AS split FROM T, b WHERE timestamp < {SQL_TAIL_CUTOFF})
SELECT txn_id, split FROM s""")
def q_assign_split(spark, sf_dir):
    t = truncate_tail(T(spark, sf_dir, end=TAIL_CUTOFF), TAIL_CUTOFF)
    return assign_split(t, frozen_split(spark, sf_dir)).select("txn_id", "split")


@register("q_split_manifest", _BOUNDS_SQL + f""",
s AS (SELECT *, CASE WHEN timestamp < train_end THEN 'train' WHEN timestamp < val_end THEN 'validation'
       ELSE 'test' END AS split FROM T, b WHERE timestamp < {SQL_TAIL_CUTOFF})
SELECT split, count(*) AS transactions, CAST(sum(is_laundering) AS BIGINT) AS laundering,
  round(sum(is_laundering) / count(*), 8) AS laundering_rate,
  strftime(min(timestamp), '%Y-%m-%dT%H:%M:%S') AS first, strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S') AS last,
  strftime(any_value(train_end), '%Y-%m-%dT%H:%M:%S') AS train_end, strftime(any_value(val_end), '%Y-%m-%dT%H:%M:%S') AS val_end,
  (SELECT count(*) FROM T WHERE timestamp >= {SQL_TAIL_CUTOFF}) AS tail_rows_dropped
FROM s GROUP BY split""")
def q_split_manifest(spark, sf_dir):
    return split_manifest_frame(T(spark, sf_dir), TAIL_CUTOFF, SPLIT_FRACTIONS)


# FIXTURES: day slice of the validation window, 2024-01-20 [00:00, 24:00).
@register("q_day_slice", f"""SELECT {_T_COLS} FROM T
WHERE timestamp >= TIMESTAMP '2024-01-20 00:00:00' AND timestamp < TIMESTAMP '2024-01-21 00:00:00'""")
def q_day_slice(spark, sf_dir):
    import datetime as dt
    a, b = dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21)
    return time_slice(T(spark, sf_dir, a, b), a, b)


@register("q_day_slice_stored", f"""SELECT {_T_COLS} FROM T
WHERE timestamp >= TIMESTAMP '2024-01-20 00:00:00' AND timestamp < TIMESTAMP '2024-01-21 00:00:00'""")
def q_day_slice_stored(spark, sf_dir):
    """B10 on the stored layout: T written once day-partitioned (sorted by time) into the
    shared folder, then the day slice prunes directories and pushes the timestamp
    bounds into the Parquet scan."""
    import datetime as dt

    from ringwatch.plans.common import data_key
    from ringwatch.session import shared_dir
    from ringwatch.sources.transfers import load_transfers_parquet, write_transfers_parquet

    t = T(spark, sf_dir)
    path = shared_dir(spark, "transfers", data_key(t, *TRANSFER_COLUMNS))
    store_once(t, path, write_transfers_parquet)
    stored = load_transfers_parquet(spark, path)
    return time_slice(stored, dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21)).select(*TRANSFER_COLUMNS)


_SRC_COLS = ", ".join(SOURCE_COLUMNS)


@register("q_load_csv", f"SELECT {_SRC_COLS} FROM T")
def q_load_csv(spark, sf_dir):
    """A1: T written as the source's CSV (repeated header name, text timestamps), then loaded by position."""
    import uuid

    from ringwatch.session import shared_dir

    path = shared_dir(spark, f"csv-{uuid.uuid4().hex}")
    write_transfers_csv(T(spark, sf_dir), path)
    return load_transactions_csv(spark, path).select(*SOURCE_COLUMNS)


@register("q_split_integrity", """
SELECT * FROM (VALUES ('as frozen', 'accepted'), ('text changed', 'rejected'), ('checksum missing', 'rejected')) v(manifest, verdict)""")
def q_split_integrity(spark, sf_dir):
    """The frozen split passes; copies of it with a changed text or without the checksum don't."""
    import uuid

    from ringwatch.plans.common import freeze
    from ringwatch.session import shared_dir
    from ringwatch.sources.manifest import MANIFEST_SCHEMA, verify_manifest

    folder = freeze(T(spark, sf_dir), f"{sf_dir}/events.parquet")
    row = spark.read.schema(MANIFEST_SCHEMA).parquet(folder)
    copies = {"as frozen": row, "text changed": row.withColumn("manifest", F.regexp_replace("manifest", "2024", "2025")),
              "checksum missing": row.withColumn("sha256", F.lit(None).cast("string"))}
    verdicts = []
    for name, copy in copies.items():
        path = shared_dir(spark, f"integrity-{uuid.uuid4().hex}")
        copy.write.parquet(path)
        try:
            verify_manifest(spark, path)
            verdicts.append((name, "accepted"))
        except (ValueError, FileNotFoundError):
            verdicts.append((name, "rejected"))
    return spark.createDataFrame(verdicts, "manifest string, verdict string")


@register("q_split_refrozen", _BOUNDS_SQL + """,
c2 AS (SELECT timestamp FROM T WHERE timestamp < TIMESTAMP '2024-01-15 00:00:00'), n2 AS (SELECT count(*) AS n FROM c2),
r2 AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) AS rn FROM c2),
b2 AS (SELECT max(CASE WHEN rn = CAST(floor((n - 1) * CAST(0.6 AS DOUBLE) + 0.5) AS BIGINT) + 1 THEN timestamp END) AS train_end,
  max(CASE WHEN rn = CAST(floor((n - 1) * CAST(0.8 AS DOUBLE) + 0.5) AS BIGINT) + 1 THEN timestamp END) AS val_end FROM r2, n2)
SELECT 'all rows' AS data, strftime(train_end, '%Y-%m-%dT%H:%M:%S') AS train_end, strftime(val_end, '%Y-%m-%dT%H:%M:%S') AS val_end FROM b
UNION ALL SELECT 'first half', strftime(train_end, '%Y-%m-%dT%H:%M:%S'), strftime(val_end, '%Y-%m-%dT%H:%M:%S') FROM b2""")
def q_split_refrozen(spark, sf_dir):
    """A3/A4: other rows under the same name get their own frozen boundaries, the first ones stay."""
    import datetime as dt

    from ringwatch.plans.common import freeze
    from ringwatch.sources.manifest import frozen_boundaries

    name = f"{sf_dir}/events.parquet"
    first = freeze(T(spark, sf_dir), name)
    half = freeze(T(spark, sf_dir, end=dt.datetime(2024, 1, 15)), name)
    rows = [(k, *(x.isoformat() for x in frozen_boundaries(spark, f))) for k, f in (("all rows", first), ("first half", half))]
    return spark.createDataFrame(rows, "data string, train_end string, val_end string")


@register("q_snapshot_index", """
SELECT txn_id, CAST(date_sub('day', (SELECT min(timestamp) FROM T), timestamp) AS INTEGER) AS snapshot FROM T""")
def q_snapshot_index(spark, sf_dir):
    return snapshot_index(T(spark, sf_dir)).select("txn_id", "snapshot")


_RINGS_SQL = """rings AS (
  SELECT timestamp, from_account, to_account, amount_paid, pattern_id,
    row_number() OVER (PARTITION BY pattern_id ORDER BY timestamp, txn_id) - 1 AS hop
  FROM T WHERE pattern_id >= 0),
dup AS (SELECT * FROM rings UNION ALL SELECT timestamp, from_account, to_account, amount_paid, pattern_id + 1000, hop
        FROM rings WHERE pattern_id % 3 = 0),
lookup AS (SELECT timestamp, from_account, to_account, amount_paid, pattern_id FROM (
  SELECT *, row_number() OVER (PARTITION BY timestamp, from_account, to_account, amount_paid
                               ORDER BY pattern_id, hop) AS rn FROM dup) WHERE rn = 1)"""


def rings_with_copies(spark, sf_dir):
    """Ring table from T plus a second copy of every third ring under a higher id (tests keep-first)."""
    rings = rings_from_transfers(T_with_pattern(spark, sf_dir))
    return rings.unionByName(rings.filter(F.col("pattern_id") % 3 == 0)
                             .withColumn("pattern_id", (F.col("pattern_id") + 1000).cast("int")))


@register("q_attach_patterns", f"""WITH {_RINGS_SQL}
SELECT t.txn_id, CAST(coalesce(l.pattern_id, -1) AS INTEGER) AS pattern_id
FROM T t LEFT JOIN lookup l USING (timestamp, from_account, to_account, amount_paid)""")
def q_attach_patterns(spark, sf_dir):
    return attach_pattern_ids(T(spark, sf_dir), rings_with_copies(spark, sf_dir)).select("txn_id", "pattern_id")


@register("q_load_split_validation", _BOUNDS_SQL + f""", {_RINGS_SQL}
SELECT t.txn_id, t.timestamp, t.from_account, t.to_account, t.amount_paid, t.is_laundering,
  CAST(coalesce(l.pattern_id, -1) AS INTEGER) AS pattern_id
FROM T t CROSS JOIN b LEFT JOIN lookup l USING (timestamp, from_account, to_account, amount_paid)
WHERE t.timestamp < {SQL_TAIL_CUTOFF} AND t.timestamp >= b.train_end AND t.timestamp < b.val_end""")
def q_load_split_validation(spark, sf_dir):
    from ringwatch.plans.common import load_split
    return load_split(spark, sf_dir, "validation").select(
        "txn_id", "timestamp", "from_account", "to_account", "amount_paid", "is_laundering", "pattern_id")
