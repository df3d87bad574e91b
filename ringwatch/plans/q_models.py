"""Registered queries: class balance, scaler, MLlib models and their comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.graph import edge_inputs, graph_off, two_hop_mean_by_day
from ringwatch.operators.history import build_account_history_features
from ringwatch.operators.joins import attach_pattern_ids
from ringwatch.operators.metrics import evaluate, rank_by_amount, rank_randomly, to_scored
from ringwatch.operators.models import (ARTIFACT_COLUMNS, EDGE_GRID, PARITY_FEATURES, TREE_FEATURES, TRIALS, check_alignment,
                                        class_balance, compare, draw_trials, feature_importance, fit_edge_scorer, fit_tree,
                                        materialised, scaled_inputs, score_with, sweep_edge_scorer)
from ringwatch.operators.scaler import EdgeScaler
from ringwatch.operators.split import select_split, truncate_tail
from ringwatch.plans.catalog import register
from ringwatch.plans.common import (K_VALUES, SEED, SQL_TAIL_CUTOFF, T, TAIL_CUTOFF, frozen_split, load_split,
                                    round_doubles)
from ringwatch.plans.q_features import history_ctes
from ringwatch.plans.q_ingest import _BOUNDS_SQL, rings_with_copies
from ringwatch.plans.q_metrics import evaluate_sql

_PF = list(PARITY_FEATURES)


@register("q_class_balance", _BOUNDS_SQL + f""",
tr AS (SELECT t.is_laundering FROM T t, b WHERE t.timestamp < {SQL_TAIL_CUTOFF} AND t.timestamp < b.train_end)
SELECT CAST(sum(CASE WHEN is_laundering = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
  CAST(sum(CASE WHEN is_laundering = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative,
  round(sum(CASE WHEN is_laundering = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN is_laundering = 1 THEN 1 ELSE 0 END), 6)
    AS pos_weight FROM tr""")
def q_class_balance(spark, sf_dir):
    t = truncate_tail(T(spark, sf_dir, end=TAIL_CUTOFF), TAIL_CUTOFF)
    return round_doubles(class_balance(select_split(t, "train", frozen_split(spark, sf_dir))))


def _features(spark, sf_dir):
    """Rows before val_end with row and history features, and their training part (before train_end)."""
    train_end, val_end = frozen_split(spark, sf_dir)
    f = build_account_history_features(build_basic_features(T(spark, sf_dir, end=val_end)), val_end)
    return f, select_split(f, "train", (train_end, val_end))


def prepared_sql(c: str) -> str:
    """The scaler's preparation of one column."""
    return (f"CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN 0.0 WHEN {c} > 0 THEN ln(1 + {c}) "
            f"ELSE CAST({c} AS DOUBLE) END")


def moments_sql(cols, source: str) -> str:
    """(feature, mean, std) of prepared columns."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(avg({c}), 0.0) AS mean, CASE WHEN stddev_samp({c}) IS NULL OR "
        f"stddev_samp({c}) <= 1e-9 THEN 1.0 ELSE stddev_samp({c}) END AS std FROM {source}" for c in cols)


_FEAT_SQL = _BOUNDS_SQL + f""", {history_ctes('(SELECT val_end FROM b)')},
feat AS (SELECT h.*, t.timestamp < (SELECT train_end FROM b) AS in_train,
    CAST(hour(t.timestamp) AS INTEGER) AS hour, CAST(isodow(t.timestamp) AS INTEGER) AS weekday,
    ln(1 + t.amount_paid) AS log_amount,
    CASE WHEN t.amount_paid > 0 THEN t.amount_received / t.amount_paid ELSE 1.0 END AS amount_ratio,
    CAST(t.from_bank = t.to_bank AS INTEGER) AS is_same_bank
  FROM hist h JOIN T t USING (txn_id)),
prep AS (SELECT txn_id, in_train, {', '.join(f"{prepared_sql(c)} AS {c}" for c in _PF)} FROM feat),
fitted AS (SELECT * FROM prep WHERE in_train),
mom AS ({moments_sql(_PF, 'fitted')})"""


@register("q_scaler_fit", _FEAT_SQL + "\nSELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM mom")
def q_scaler_fit(spark, sf_dir):
    """Moments of the training rows only."""
    return round_doubles(EdgeScaler.moments_frame(_features(spark, sf_dir)[1], _PF))


@register("q_scaler_transform", _FEAT_SQL + f"""
SELECT txn_id, {', '.join(f"round((p.{c} - (SELECT mean FROM mom WHERE feature = '{c}')) / "
                         f"(SELECT std FROM mom WHERE feature = '{c}'), 6) AS {c}" for c in _PF)}
FROM prep p""")
def q_scaler_transform(spark, sf_dir):
    """Training and validation rows scaled by the training moments."""
    f = materialised(_features(spark, sf_dir)[0].select("txn_id", "timestamp", *_PF))
    sc = EdgeScaler.fit(select_split(f, "train", frozen_split(spark, sf_dir)), _PF)
    return round_doubles(sc.transform(f.select("txn_id", *_PF), _PF))


@register("q_parity_columns", _FEAT_SQL + f"""
SELECT txn_id, {', '.join(f"round({c}, 6) AS {c}" for c in _PF)} FROM feat""")
def q_parity_columns(spark, sf_dir):
    """The 14 columns that all models share."""
    return round_doubles(_features(spark, sf_dir)[0].select("txn_id", *[F.col(c).cast("double").alias(c) for c in _PF]))


def _model_frames(spark, sf_dir):
    """Features as of val_end, computed once, then the train and validation slices of them."""
    b = frozen_split(spark, sf_dir)
    feats = build_account_history_features(build_basic_features(T(spark, sf_dir, end=b[1])), b[1])
    feats = materialised(attach_pattern_ids(truncate_tail(feats, TAIL_CUTOFF), rings_with_copies(spark, sf_dir)))
    return select_split(feats, "train", b), select_split(feats, "validation", b)


def _graph_frames(spark, sf_dir, train, valid):
    """J6 inputs of both slices (node state and neighbour means of both hops at the day start, and the
    14 parity columns scaled by the training moments) and the list of input columns. Both slices are joined to the
    node table in one job, whose rows are stored before the scaler reads them."""
    by_day = two_hop_mean_by_day(T(spark, sf_dir, end=frozen_split(spark, sf_dir)[1]))
    vcols = [c for c in by_day.columns if c not in ("account", "day")]
    cols = [f"{s}_{c}" for s in ("src", "dst") for c in vcols] + _PF

    rows = train.withColumn("_train", F.lit(True)).unionByName(valid.withColumn("_train", F.lit(False)))
    both = materialised(edge_inputs(rows, by_day, [*_PF, "pattern_id", "amount_paid", "_train"], vcols))
    return *scaled_inputs(both.filter("_train").drop("_train"), both.filter("NOT _train").drop("_train"), _PF), cols


def _gains(spark, sf_dir):
    train, _ = _model_frames(spark, sf_dir)
    full = feature_importance(fit_tree(train, TREE_FEATURES, SEED), TREE_FEATURES).withColumn("run", F.lit("all"))
    abl = feature_importance(fit_tree(train, PARITY_FEATURES, SEED), PARITY_FEATURES).withColumn("run", F.lit("ablated"))
    return full.unionByName(abl)


@register("q_feature_gain")
def q_feature_gain(spark, sf_dir):
    """K3: tree importances with all features, and with the artifact columns removed."""
    return round_doubles(_gains(spark, sf_dir))


@register("q_feature_gain_totals", f"""
SELECT * FROM (VALUES ('all', CAST({len(TREE_FEATURES)} AS BIGINT), CAST({sum(c in ARTIFACT_COLUMNS for c in TREE_FEATURES)} AS BIGINT), 1.0::DOUBLE),
  ('ablated', CAST({len(PARITY_FEATURES)} AS BIGINT), CAST(0 AS BIGINT), 1.0::DOUBLE)) v(run, features, artifacts, total)""")
def q_feature_gain_totals(spark, sf_dir):
    """K1-K3: importances of each run add up to one, and the ablated run knows no artifact column."""
    g = _gains(spark, sf_dir).groupBy("run").agg(
        F.count(F.lit(1)).alias("features"), F.sum(F.col("feature").isin(*ARTIFACT_COLUMNS).cast("bigint")).alias("artifacts"),
        F.round(F.sum("importance"), 6).alias("total"))
    return g


@register("q_comparison_baselines", f"""
SELECT 'random' AS model, metric, k, round(value, 6) AS value FROM ({evaluate_sql('random')} SELECT * FROM tidy)
UNION ALL SELECT 'amount', metric, k, round(value, 6) FROM ({evaluate_sql('amount')} SELECT * FROM tidy)""")
def q_comparison_baselines(spark, sf_dir):
    """K6: the lines of the comparison that need no training."""
    valid = load_split(spark, sf_dir, "validation")
    return round_doubles(compare({"random": evaluate(to_scored(valid, rank_randomly(valid, SEED)), K_VALUES),
                                  "amount": evaluate(to_scored(valid, rank_by_amount()), K_VALUES)}))


def _scores(spark, sf_dir):
    """(model -> scored validation rows), the validation rows, and the graph model with its inputs."""
    train, valid = _model_frames(spark, sf_dir)
    tr_in, va_in, cols = _graph_frames(spark, sf_dir, train, valid)
    graph, off = fit_edge_scorer(tr_in, cols), fit_edge_scorer(graph_off(tr_in), cols)
    scores = {"tree": score_with(fit_tree(train, PARITY_FEATURES, SEED), valid), "graph": score_with(graph, va_in),
              "graph_off": score_with(off, graph_off(va_in))}
    return scores, valid, off, va_in


@register("q_scored_rows", _BOUNDS_SQL + f""",
v AS (SELECT count(*) AS n FROM T, b WHERE timestamp >= train_end AND timestamp < val_end AND timestamp < {SQL_TAIL_CUTOFF})
SELECT model, n AS n_rows, n AS scored_once, CAST(0 AS BIGINT) AS without_score, CAST(0 AS BIGINT) AS outside_range
FROM v, (SELECT unnest(['tree', 'graph', 'graph_off']) AS model)""")
def q_scored_rows(spark, sf_dir):
    """K1, K5, K6: every validation row has exactly one score of every model, between 0 and 1."""
    scores, valid, _, _ = _scores(spark, sf_dir)
    out = None
    for name, s in scores.items():
        per = s.groupBy("txn_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"))
        one = valid.select("txn_id").join(per, "txn_id", "left").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("n") == 1).cast("bigint")).alias("scored_once"),
            F.sum(F.col("n").isNull().cast("bigint")).alias("without_score"),
            F.sum((~F.col("score").between(0, 1)).cast("bigint")).alias("outside_range")).select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("q_graph_off_scores", _BOUNDS_SQL + f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS changed FROM T, b
WHERE timestamp >= train_end AND timestamp < val_end AND timestamp < {SQL_TAIL_CUTOFF}""")
def q_graph_off_scores(spark, sf_dir):
    """The graph-off model's scores don't change when the node columns do."""
    _, _, off, inputs = _scores(spark, sf_dir)
    moved = inputs.select(*[(F.col(c) * 3 + 1).alias(c) if c.startswith(("src_", "dst_")) else F.col(c) for c in inputs.columns])
    a = score_with(off, graph_off(inputs)).select("txn_id", "score")
    b = score_with(off, graph_off(moved)).select("txn_id", F.col("score").alias("other"))
    return a.join(b, "txn_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum((F.abs(F.col("score") - F.col("other")) > 1e-12).cast("bigint")).alias("changed"))


@register("q_sweep", f"""SELECT 'edge_sweep' AS experiment, CAST({TRIALS} AS BIGINT) AS trials, CAST({TRIALS} AS BIGINT) AS with_score,
  CAST({len({tuple(sorted(p.items())) for p in draw_trials(EDGE_GRID)})} AS BIGINT) AS settings""")
def q_sweep(spark, sf_dir):
    """K4: a sweep of the graph model as a job, every trial logged and read back."""
    import uuid

    from ringwatch.session import shared_dir
    from ringwatch.sources.tracking import read_runs

    path = shared_dir(spark, f"sweep-{uuid.uuid4().hex}")
    tr_in, va_in, cols = _graph_frames(spark, sf_dir, *_model_frames(spark, sf_dir))
    sweep_edge_scorer(tr_in, va_in, cols, log_path=path)
    runs = read_runs(spark, path, "edge_sweep")
    keys = sorted(EDGE_GRID)
    return runs.groupBy("experiment").agg(
        F.count(F.lit(1)).alias("trials"), F.sum(F.col("metrics")["pr_auc"].between(0, 1).cast("bigint")).alias("with_score"),
        F.countDistinct(*[F.col("params")[k] for k in keys]).alias("settings"))


@register("q_model_comparison")
def q_model_comparison(spark, sf_dir):
    """K6: random, amount, graph-off, graph (weighted LR on J6) and tree through one evaluate, on the same columns."""
    scores, valid, _, _ = _scores(spark, sf_dir)
    res = {"random": to_scored(valid, rank_randomly(valid, SEED)), "amount": to_scored(valid, rank_by_amount()), **scores}
    res = {name: materialised(s) for name, s in res.items()}
    for s in res.values():
        check_alignment(s, valid)
    return round_doubles(compare({name: evaluate(s, K_VALUES, materialize=False) for name, s in res.items()}))
