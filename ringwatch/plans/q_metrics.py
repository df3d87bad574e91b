"""Registered queries: baselines and ranking metrics on the validation split."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringwatch.functions.hashing import duckdb_uniform_from_key
from ringwatch.operators.metrics import (cost_at_k, evaluate, flatten_metrics, lift_at_k, pattern_recall, pr_auc_frame,
                                         precision_at_k, rank_by_amount, rank_randomly, to_scored, top_k)
from ringwatch.functions.money import duckdb_sum
from ringwatch.plans.catalog import register
from ringwatch.plans.common import K_VALUES, SEED, SQL_TAIL_CUTOFF, T, load_split, round_doubles
from ringwatch.plans.q_ingest import _BOUNDS_SQL, _RINGS_SQL

KMAX = max(K_VALUES)
_KLIST = ", ".join(str(k) for k in K_VALUES)
SCORE_SQL = {"amount": "t.amount_paid", "random": duckdb_uniform_from_key(SEED, "t.txn_id")}


def scored_sql(model: str) -> str:
    """CTE prefix: ``scored`` = validation rows with ring ids and the model's score."""
    return _BOUNDS_SQL + f""", {_RINGS_SQL},
scored AS (
  SELECT t.txn_id, t.is_laundering AS y, CAST({SCORE_SQL[model]} AS DOUBLE) AS score,
    CAST(coalesce(l.pattern_id, -1) AS INTEGER) AS pattern_id, t.amount_paid AS amount
  FROM T t CROSS JOIN b LEFT JOIN lookup l USING (timestamp, from_account, to_account, amount_paid)
  WHERE t.timestamp < {SQL_TAIL_CUTOFF} AND t.timestamp >= b.train_end AND t.timestamp < b.val_end)"""


def scored_frame(spark, sf_dir, model: str, rings: bool = True):
    v = load_split(spark, sf_dir, "validation", rings=rings)
    score = rank_by_amount() if model == "amount" else rank_randomly(v, SEED)
    return to_scored(v, score)


@register("q_rank_amount", scored_sql("amount") + "\nSELECT txn_id, score FROM scored")
def q_rank_amount(spark, sf_dir):
    return scored_frame(spark, sf_dir, "amount", rings=False).select("txn_id", "score")


@register("q_rank_random", scored_sql("random") + "\nSELECT txn_id, round(score, 6) AS score FROM scored")
def q_rank_random(spark, sf_dir):
    return round_doubles(scored_frame(spark, sf_dir, "random", rings=False).select("txn_id", "score"))


@register("q_topk_flags", scored_sql("amount") + f"""
SELECT txn_id, score, CAST(rnk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY score DESC, txn_id) AS rnk FROM scored) WHERE rnk <= {KMAX}""")
def q_topk_flags(spark, sf_dir):
    return top_k(scored_frame(spark, sf_dir, "amount"), KMAX).select("txn_id", "score", "rank")


def evaluate_sql(model: str, k_values=K_VALUES) -> str:
    klist = ", ".join(str(k) for k in k_values)
    return scored_sql(model) + f""",
ks AS (SELECT unnest([{klist}]) AS k),
tot AS (SELECT count(*) AS n, sum(y) AS npos,
        sum(CASE WHEN y = 1 THEN {duckdb_sum('amount')} ELSE 0 END) AS posvalue FROM scored),
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, txn_id) AS rnk FROM scored),
kk AS (SELECT k, least(k, n) AS ke, n, npos, posvalue FROM ks, tot),
cut AS (SELECT kk.*, r.score AS cutoff FROM kk JOIN ranked r ON r.rnk = kk.ke),
pk AS (SELECT c.k, c.ke, c.n, c.npos, c.posvalue,
    sum(CASE WHEN s.score > c.cutoff THEN 1 ELSE 0 END) AS above,
    sum(CASE WHEN s.score > c.cutoff THEN s.y ELSE 0 END) AS pos_above,
    sum(CASE WHEN s.score = c.cutoff THEN 1 ELSE 0 END) AS tied,
    sum(CASE WHEN s.score = c.cutoff THEN s.y ELSE 0 END) AS pos_tied,
    sum(CASE WHEN s.rnk <= c.ke AND s.y = 1 THEN {duckdb_sum('s.amount')} ELSE 0 END) AS caught
  FROM cut c, ranked s GROUP BY c.k, c.ke, c.n, c.npos, c.posvalue),
prec AS (SELECT *, (pos_above + CASE WHEN tied > 0 AND ke - above > 0
                                 THEN pos_tied * (ke - above) / tied ELSE 0.0 END) / ke AS p FROM pk),
rr AS (SELECT k, pattern_id, count(*) AS members, sum(CASE WHEN rnk <= ke THEN 1 ELSE 0 END) AS flagged
       FROM ranked, kk WHERE pattern_id <> -1 GROUP BY k, pattern_id),
ring AS (SELECT k, count(*) AS np, sum(CASE WHEN flagged / members >= 0.5 THEN 1 ELSE 0 END) AS nc,
           sum(CASE WHEN flagged > 0 THEN 1 ELSE 0 END) AS nh FROM rr GROUP BY k),
g AS (SELECT score, count(*) AS c, sum(y) AS pos FROM scored GROUP BY score),
gc AS (SELECT *, sum(c) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
                 sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp FROM g),
ap AS (SELECT sum(pos * cp / cn) / sum(pos) AS v FROM gc),
tidy AS (
  SELECT 'pr_auc' AS metric, CAST(NULL AS BIGINT) AS k, CAST(v AS DOUBLE) AS value FROM ap
  UNION ALL SELECT 'base_rate', NULL, npos / n FROM tot
  UNION ALL SELECT 'n_rows', NULL, CAST(n AS DOUBLE) FROM tot
  UNION ALL SELECT 'n_positives', NULL, CAST(npos AS DOUBLE) FROM tot
  UNION ALL SELECT 'precision_at_k', k, p FROM prec
  UNION ALL SELECT 'lift_at_k', k, CASE WHEN npos > 0 THEN p / (npos / n) END FROM prec
  UNION ALL SELECT 'cost_investigator_hours', k, ke * 0.5 FROM prec
  UNION ALL SELECT 'cost_laundering_value_caught', k, CAST(caught AS DOUBLE) FROM prec
  UNION ALL SELECT 'cost_laundering_value_missed', k, CAST(posvalue - caught AS DOUBLE) FROM prec
  UNION ALL SELECT 'pattern_n_patterns', k, CAST(np AS DOUBLE) FROM ring
  UNION ALL SELECT 'pattern_n_caught', k, CAST(nc AS DOUBLE) FROM ring
  UNION ALL SELECT 'pattern_recall', k, CASE WHEN np > 0 THEN nc / np ELSE 0.0 END FROM ring
  UNION ALL SELECT 'pattern_hit_rate', k, CASE WHEN np > 0 THEN nh / np ELSE 0.0 END FROM ring
  UNION ALL SELECT 'pattern_threshold', k, 0.5 FROM ring)"""


def _tidy_out(filter_sql: str = "") -> str:
    return f"\nSELECT metric, k, round(value, 6) AS value FROM tidy {filter_sql}"


def _eval(spark, sf_dir, model):
    return evaluate(scored_frame(spark, sf_dir, model), K_VALUES)


@register("q_evaluate_amount", evaluate_sql("amount") + _tidy_out())
def q_evaluate_amount(spark, sf_dir):
    return round_doubles(_eval(spark, sf_dir, "amount"))


@register("q_evaluate_random", evaluate_sql("random") + _tidy_out())
def q_evaluate_random(spark, sf_dir):
    return round_doubles(_eval(spark, sf_dir, "random"))


@register("q_precision_at_k", evaluate_sql("amount") +
          "\nSELECT k, round(value, 6) AS precision FROM tidy WHERE metric = 'precision_at_k'")
def q_precision_at_k(spark, sf_dir):
    return round_doubles(precision_at_k(scored_frame(spark, sf_dir, "amount", rings=False), K_VALUES))


@register("q_lift_at_k", evaluate_sql("amount") +
          "\nSELECT k, round(value, 6) AS lift FROM tidy WHERE metric = 'lift_at_k'")
def q_lift_at_k(spark, sf_dir):
    return round_doubles(lift_at_k(scored_frame(spark, sf_dir, "amount", rings=False), K_VALUES))


@register("q_cost_at_k", evaluate_sql("amount") + _tidy_out("WHERE metric LIKE 'cost_%'"))
def q_cost_at_k(spark, sf_dir):
    return round_doubles(cost_at_k(scored_frame(spark, sf_dir, "amount", rings=False), K_VALUES))


@register("q_pattern_recall", evaluate_sql("random") + _tidy_out("WHERE metric LIKE 'pattern_%'"))
def q_pattern_recall(spark, sf_dir):
    return round_doubles(pattern_recall(scored_frame(spark, sf_dir, "random"), K_VALUES))


@register("q_pr_auc", evaluate_sql("amount") + """
SELECT 'amount' AS model, round(value, 6) AS pr_auc FROM tidy WHERE metric = 'pr_auc'""")
def q_pr_auc(spark, sf_dir):
    ap = pr_auc_frame(scored_frame(spark, sf_dir, "amount", rings=False))
    return round_doubles(ap.select(F.lit("amount").alias("model"), F.col("pr_auc").cast("double").alias("pr_auc")))


def flat_sql(model: str) -> str:
    return evaluate_sql(model) + """
SELECT name, round(value, 6) AS value FROM (
  SELECT CASE WHEN k IS NULL THEN metric
              WHEN metric = 'precision_at_k' THEN 'precision_at_' || k
              WHEN metric = 'lift_at_k' THEN 'lift_at_' || k
              WHEN metric = 'pattern_recall' THEN 'pattern_recall_at_' || k
              WHEN metric = 'pattern_hit_rate' THEN 'pattern_hit_rate_at_' || k
              WHEN metric = 'cost_laundering_value_missed' THEN 'value_missed_at_' || k END AS name, value
  FROM tidy) WHERE name IS NOT NULL"""


@register("q_metrics_flat", flat_sql("amount"))
def q_metrics_flat(spark, sf_dir):
    return round_doubles(flatten_metrics(_eval(spark, sf_dir, "amount")))


def run_baselines(spark, sf_dir, runs_path: str | None = None):
    """H7: both baselines on the validation split through one evaluate each,
    flattened (A7) and, when ``runs_path`` is given, appended to the runs table (A6)."""
    from ringwatch.sources.tracking import log_metrics_frame

    out = None
    for model in ("random", "amount"):
        flat = flatten_metrics(_eval(spark, sf_dir, model))
        if runs_path:
            log_metrics_frame(flat, runs_path, "baselines",
                              {"model": model, "split": "validation", "seed": SEED, "kind": "baseline"},
                              {"baseline": "true"})
        flat = flat.select(F.lit(model).alias("model"), "name", "value")
        out = flat if out is None else out.unionByName(flat)
    return out


@register("q_baselines_report", f"""
SELECT * FROM (SELECT 'random' AS model, * FROM ({flat_sql('random')}))
UNION ALL
SELECT * FROM (SELECT 'amount' AS model, * FROM ({flat_sql('amount')}))""")
def q_baselines_report(spark, sf_dir):
    import uuid

    from ringwatch.session import shared_dir
    return round_doubles(run_baselines(spark, sf_dir, shared_dir(spark, f"runs-{uuid.uuid4().hex}")))


@register("q_run_tracking", """
SELECT 'transfers' AS experiment, 'T' AS data, '2' AS phase, name, value FROM (
  SELECT 'n_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM T
  UNION ALL SELECT 'positives', CAST(sum(is_laundering) AS DOUBLE) FROM T)""")
def q_run_tracking(spark, sf_dir):
    """A run with its parameters, metrics and tags is logged and read back, beside another experiment's."""
    import uuid

    from ringwatch.session import shared_dir
    from ringwatch.sources.tracking import log_metrics_frame, log_run, read_runs

    path = shared_dir(spark, f"runs-{uuid.uuid4().hex}")
    flat = T(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_laundering").alias("positives")).unpivot(
        [], ["n_rows", "positives"], "name", "value")
    log_metrics_frame(flat, path, "transfers", {"data": "T"}, {"phase": "2"})
    log_run(spark, path, "other", {"data": "none"}, {"n_rows": 0.0})
    return read_runs(spark, path, "transfers").select(
        "experiment", F.col("params")["data"].alias("data"), F.col("tags")["phase"].alias("phase"), F.explode("metrics").alias("name", "value"))
