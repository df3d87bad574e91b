"""Registered queries: parity, alert queue, ego network, capacity curve, drift,
champion / challenger, alert forecast, staleness, leak audit (N2-N10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringwatch.functions.hashing import duckdb_uniform_from_key
from ringwatch.operators.history import HISTORY_FEATURES, build_account_history_features
from ringwatch.operators.monitoring import (alert_forecast, alert_queue, capacity_curve, champion_challenger,
                                            ego_network, leak_audit, parity, psi, staleness)
from ringwatch.operators.graph import snapshot_edges
from ringwatch.operators.metrics import rank_by_amount, rank_randomly
from ringwatch.operators.scaler import EdgeScaler
from ringwatch.operators.reports import top_senders
from ringwatch.operators.split import select_split
from ringwatch.plans.catalog import register
from ringwatch.plans.common import AS_OF, SEED, SQL_AS_OF, SQL_TAIL_CUTOFF, T, T_split, frozen_split, round_doubles
from ringwatch.plans.q_features import history_ctes
from ringwatch.plans.q_ingest import _BOUNDS_SQL
from ringwatch.plans.q_metrics import evaluate_sql, scored_frame
from ringwatch.plans.q_models import moments_sql, prepared_sql

_HF = list(HISTORY_FEATURES)


@register("q_parity", "SELECT unnest([" + ", ".join(f"'{c}'" for c in _HF) + "]) AS feature, CAST(0 AS BIGINT) AS differing")
def q_parity(spark, sf_dir):
    """The history of whole id ranges and of ids scattered over many blocks, cell by cell."""
    t = T(spark, sf_dir, end=AS_OF)
    return parity(build_account_history_features(t, AS_OF), build_account_history_features(t, AS_OF, id_block=16), "txn_id", _HF)


REASONS = ["sender_n_sent_before", "sender_distinct_out_before", "sender_sent_last_24h",
           "receiver_n_received_before", "receiver_distinct_in_before"]
QUEUE_K = 20


@register("q_alert_queue", _BOUNDS_SQL + f""", {history_ctes()},
sf AS (SELECT t.txn_id, t.from_account, t.timestamp, t.amount_paid AS score, h.* EXCLUDE (txn_id) FROM T t JOIN hist h USING (txn_id)),
prep AS (SELECT txn_id, from_account, score, timestamp < (SELECT train_end FROM b) AS in_train,
  {', '.join(f"{prepared_sql(c)} AS {c}" for c in REASONS)} FROM sf),
fitted AS (SELECT * FROM prep WHERE in_train),
mom AS ({moments_sql(REASONS, 'fitted')}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_account ORDER BY score DESC, txn_id) AS rn
         FROM prep) WHERE rn = 1),
top AS (SELECT * FROM best ORDER BY score DESC, from_account LIMIT {QUEUE_K}),
u AS ({' UNION ALL '.join(f"SELECT from_account, '{c}' AS name, CAST({c} AS DOUBLE) AS raw FROM top" for c in REASONS)}),
z AS (SELECT u.from_account, u.name, round((u.raw - mom.mean) / mom.std, 6) AS v FROM u JOIN mom ON mom.feature = u.name),
why AS (SELECT from_account, string_agg(name, ',' ORDER BY v DESC, name) AS reasons FROM (
        SELECT *, row_number() OVER (PARTITION BY from_account ORDER BY v DESC, name) AS rn FROM z) WHERE rn <= 3
      GROUP BY from_account)
SELECT top.from_account AS account, top.score AS max_score, top.txn_id AS top_txn_id, why.reasons
FROM top JOIN why USING (from_account)""")
def q_alert_queue(spark, sf_dir):
    """Queue by the amount baseline (F4), reasons in training standard deviations."""
    f = build_account_history_features(T(spark, sf_dir, end=AS_OF), AS_OF).withColumn("score", rank_by_amount())
    scaler = EdgeScaler.fit(select_split(f, "train", frozen_split(spark, sf_dir)), REASONS)
    return alert_queue(f, REASONS, scaler, QUEUE_K)


def _ego_sql(hops: int, edges: str) -> str:
    """Walks of up to ``hops`` edges from the seeds; an edge's hop is its payer's least distance plus one."""
    return f"""WITH RECURSIVE e0 AS (SELECT txn_id, from_account AS src, to_account AS dst FROM T
                                   WHERE timestamp < {SQL_AS_OF}),
e AS ({edges}),
seeds AS (SELECT from_account AS account FROM T GROUP BY 1 ORDER BY count(*) DESC, from_account LIMIT 3),
walk AS (SELECT account, 0 AS d FROM seeds
         UNION SELECT e.dst, walk.d + 1 FROM walk JOIN e ON e.src = walk.account WHERE walk.d < {hops - 1}),
dist AS (SELECT account, min(d) AS d FROM walk GROUP BY account)
SELECT e.txn_id, e.src, e.dst, CAST(dist.d + 1 AS INTEGER) AS hop FROM e JOIN dist ON e.src = dist.account"""


def _ego(spark, sf_dir, **kw):
    seeds = top_senders(T(spark, sf_dir), 3).select(F.col("from_account").alias("account"))
    edges = snapshot_edges(T(spark, sf_dir, end=AS_OF), AS_OF).select("txn_id", "src", "dst")
    return ego_network(edges, seeds, **kw).select("txn_id", "src", "dst", F.col("hop").cast("int").alias("hop"))


@register("q_ego_network", _ego_sql(2, "SELECT * FROM e0"))
def q_ego_network(spark, sf_dir):
    """Every edge within two hops, once."""
    return _ego(spark, sf_dir, hops=2)


EGO_FANOUT = 3


@register("q_ego_network_sampled", _ego_sql(4, f"""SELECT txn_id, src, dst FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY {duckdb_uniform_from_key(SEED, 'txn_id')}, txn_id) AS rn FROM e0)
  WHERE rn <= {EGO_FANOUT}"""))
def q_ego_network_sampled(spark, sf_dir):
    """N4 with F6's cap: four hops over at most three payments per payer."""
    return _ego(spark, sf_dir, hops=4, fanout=EGO_FANOUT, seed=SEED)


CURVE_K = list(range(100, 2001, 100))


@register("q_capacity_curve", evaluate_sql("amount", CURVE_K) + """
SELECT k, round(max(CASE WHEN metric = 'precision_at_k' THEN value END), 6) AS precision_at_k,
  round(max(CASE WHEN metric = 'lift_at_k' THEN value END), 6) AS lift_at_k,
  round(max(CASE WHEN metric = 'cost_investigator_hours' THEN value END), 6) AS cost_investigator_hours,
  round(max(CASE WHEN metric = 'cost_laundering_value_caught' THEN value END), 6) AS cost_laundering_value_caught,
  round(max(CASE WHEN metric = 'cost_laundering_value_missed' THEN value END), 6) AS cost_laundering_value_missed
FROM tidy WHERE k IS NOT NULL GROUP BY k""")
def q_capacity_curve(spark, sf_dir):
    return round_doubles(capacity_curve(scored_frame(spark, sf_dir, "amount", rings=False), CURVE_K))


_PSI_SIDES = _BOUNDS_SQL + f""",
s0 AS (SELECT t.*, CASE WHEN t.timestamp < b.train_end THEN 'e' WHEN t.timestamp < b.val_end THEN 'a' END AS side
      FROM T t, b WHERE t.timestamp < {SQL_TAIL_CUTOFF})"""


def _psi_sql(name: str, value: str) -> str:
    return f"""SELECT '{name}' AS drift, bin, n_expected, n_actual, round((pa - pe) * ln(pa / pe), 6) AS contribution,
  round(sum((pa - pe) * ln(pa / pe)) OVER (), 6) AS psi FROM (
  SELECT *, greatest(n_expected / sum(n_expected) OVER (), 1e-6) AS pe, greatest(n_actual / sum(n_actual) OVER (), 1e-6) AS pa
  FROM (SELECT bin, CAST(sum(CASE WHEN side = 'e' THEN 1 ELSE 0 END) AS BIGINT) AS n_expected,
        CAST(sum(CASE WHEN side = 'a' THEN 1 ELSE 0 END) AS BIGINT) AS n_actual
      FROM (SELECT side, CAST(least(greatest(floor({value}), 0), 10) AS INTEGER) AS bin FROM s0 WHERE side IS NOT NULL)
      GROUP BY bin))"""


@register("q_psi", f"""{_PSI_SIDES}
{_psi_sql('log_amount', 'ln(1 + amount_paid)')}
UNION ALL {_psi_sql('amount_score', 'amount_paid / 10')}
UNION ALL {_psi_sql('random_score', f"10 * ({duckdb_uniform_from_key(SEED, 'txn_id')})")}""")
def q_psi(spark, sf_dir):
    """Drift from train to validation of a feature and of the scores of both baselines (in tenths of their range)."""
    train, valid = T_split(spark, sf_dir, "train"), T_split(spark, sf_dir, "validation")
    values = {"log_amount": F.log1p("amount_paid"), "amount_score": rank_by_amount() / 10,
              "random_score": rank_randomly(train, SEED) * 10}
    out = None
    for name, v in values.items():
        one = psi(train, valid, v).select(F.lit(name).alias("drift"), "*")
        out = one if out is None else out.unionByName(one)
    return round_doubles(out)


def _pivot_sql(model: str, label: str) -> str:
    inner = evaluate_sql(model, (100,)) + "\nSELECT metric, value FROM tidy"
    return f"""{label} AS (SELECT '{label}' AS model,
  max(CASE WHEN metric = 'pr_auc' THEN value END) AS pr_auc,
  max(CASE WHEN metric = 'precision_at_k' THEN value END) AS precision_at_k FROM ({inner}))"""


@register("q_champion", f"""WITH {_pivot_sql('amount', 'champion')}, {_pivot_sql('random', 'challenger')},
both_ AS (SELECT * FROM champion UNION ALL SELECT * FROM challenger)
SELECT model, round(pr_auc, 6) AS pr_auc, round(precision_at_k, 6) AS precision_at_k,
  CAST(model = 'challenger' AND precision_at_k > (SELECT precision_at_k FROM champion) AS INTEGER) AS promote
FROM both_""")
def q_champion(spark, sf_dir):
    cc = champion_challenger(scored_frame(spark, sf_dir, "amount", rings=False),
                              scored_frame(spark, sf_dir, "random", rings=False), 100)
    return round_doubles(cc)


ALERT_AMOUNT = 99.9  # few enough alerts that some days have none


@register("q_alert_forecast", f"""
WITH a AS (SELECT CAST(timestamp AS DATE) AS day, count(*) AS n FROM T WHERE amount_paid > {ALERT_AMOUNT} GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM a), (SELECT max(day) FROM a), INTERVAL 1 DAY)) AS DATE) AS day),
d AS (SELECT cal.day, coalesce(a.n, 0) AS alerts FROM cal LEFT JOIN a USING (day))
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(isodow(day) AS INTEGER) AS weekday, alerts,
  round(avg(alerts) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS trailing_mean,
  round(avg(alerts) OVER (PARTITION BY isodow(day) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6)
    AS same_weekday_mean
FROM d""")
def q_alert_forecast(spark, sf_dir):
    t = T(spark, sf_dir).filter(F.col("amount_paid") > ALERT_AMOUNT)
    return round_doubles(alert_forecast(t).withColumn("day", F.date_format("day", "yyyy-MM-dd")))


@register("q_staleness", f"""
WITH r AS (SELECT from_account AS account, timestamp FROM T WHERE timestamp < {SQL_AS_OF}
           UNION ALL SELECT to_account, timestamp FROM T WHERE timestamp < {SQL_AS_OF})
SELECT account, strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S') AS last_seen,
  CAST(date_diff('second', max(timestamp), {SQL_AS_OF}) AS BIGINT) AS age_seconds FROM r GROUP BY account""")
def q_staleness(spark, sf_dir):
    s = staleness(T(spark, sf_dir, end=AS_OF), AS_OF)
    return s.withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd'T'HH:mm:ss"))


@register("q_leak_audit", "SELECT 'none' AS feature, CAST(0 AS BIGINT) AS differing WHERE false")
def q_leak_audit(spark, sf_dir):
    return leak_audit(T(spark, sf_dir), AS_OF)
