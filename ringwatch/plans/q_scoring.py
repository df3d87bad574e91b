"""Registered queries: scoring as expressions, reasons, checks of what was learnt (K1-K3, N3), and the scored stream."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.compiled import CompiledLinear, CompiledTrees, explained_queue
from ringwatch.operators.history import HISTORY_FEATURES, build_account_history_features
from ringwatch.operators.metrics import evaluate, pr_auc_frame, rank_randomly, to_scored
from ringwatch.operators.models import (CATEGORY_COLUMNS, PARITY_FEATURES, TREE_FEATURES, category_codes, fit_edge_scorer, fit_tree,
                                        materialised, score_with)
from ringwatch.operators.split import select_split, truncate_tail
from ringwatch.operators.sweep import RUNGS, TREE_SETTINGS, halving_tree_sweep
from ringwatch.sources.tracking import read_runs
from ringwatch.plans.catalog import register
from ringwatch.plans.common import AS_OF, SEED, SQL_AS_OF, SQL_TAIL_CUTOFF, T, TAIL_CUTOFF, T_split, frozen_split, load_split, round_doubles
from ringwatch.plans.q_features import history_ctes
from ringwatch.plans.q_ingest import _BOUNDS_SQL
from ringwatch.plans.q_metrics import evaluate_sql
from ringwatch.session import shared_dir
from ringwatch.streaming.scored_stream import decisions, late_transfers, run_scored_stream

_ROW = [c for c in PARITY_FEATURES if c not in HISTORY_FEATURES]
_VALID_SQL = f"SELECT count(*) AS n FROM T, b WHERE timestamp >= train_end AND timestamp < val_end AND timestamp < {SQL_TAIL_CUTOFF}"


def _slices(spark, sf_dir):
    """Training and validation rows with their features, computed once for both."""
    b = frozen_split(spark, sf_dir)
    feats = materialised(truncate_tail(build_account_history_features(build_basic_features(T(spark, sf_dir, end=b[1])), b[1]), TAIL_CUTOFF))
    return select_split(feats, "train", b), select_split(feats, "validation", b)


@register("q_compiled_scores", _BOUNDS_SQL + f""", v AS ({_VALID_SQL})
SELECT model, n AS n_rows, CAST(0 AS BIGINT) AS differing FROM v, (SELECT unnest(['tree', 'tree_codes', 'logistic']) AS model)""")
def q_compiled_scores(spark, sf_dir):
    """K1, K5: every validation row's score by column expressions equals the fitted model's own."""
    train, valid = _slices(spark, sf_dir)
    fitted = {"tree": fit_tree(train, PARITY_FEATURES, SEED), "tree_codes": fit_tree(train, TREE_FEATURES, SEED),
              "logistic": fit_edge_scorer(train.na.fill(0, ["sender_seconds_since_last_send"]), list(PARITY_FEATURES))}
    out = None
    for name, model in fitted.items():
        compiled = (CompiledLinear if name == "logistic" else CompiledTrees).of(model)
        own = score_with(model, valid).select("txn_id", F.col("score").alias("own"))
        one = (compiled.score(valid).select("txn_id", "score").join(own, "txn_id", "full_outer")
               .agg(F.count(F.lit(1)).alias("n_rows"),
                    F.sum((~F.coalesce(F.abs(F.col("score") - F.col("own")) <= 1e-9, F.lit(False))).cast("bigint")).alias("differing"))
               .select(F.lit(name).alias("model"), "*"))
        out = one if out is None else out.unionByName(one)
    return out


@register("q_score_contributions", _BOUNDS_SQL + f""", v AS ({_VALID_SQL})
SELECT n AS n_rows, n AS adding_up, CAST(0 AS BIGINT) AS other_features FROM v""")
def q_score_contributions(spark, sf_dir):
    """For every validation row the base and all contributions are the raw score, and only model features contribute."""
    train, valid = _slices(spark, sf_dir)
    rows = CompiledTrees.of(fit_tree(train, PARITY_FEATURES, SEED)).score(valid, reasons=True)
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda acc, x: acc + x["value"])
    raw = F.log(F.col("score") / (1 - F.col("score"))) / 2
    known = F.array(*map(F.lit, PARITY_FEATURES))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.sum(((F.abs(total - F.col("margin")) <= 1e-9) & (F.abs(raw - F.col("margin")) <= 1e-6)).cast("bigint")).alias("adding_up"),
                    F.sum(F.size(F.filter("contributions", lambda x: ~F.array_contains(known, x["feature"])))).cast("bigint").alias("other_features"))


@register("q_explained_queue")
def q_explained_queue(spark, sf_dir):
    """The tree (K1) ranks the validation rows' payers; reasons are what raised the top transfer's score most."""
    train, valid = _slices(spark, sf_dir)
    scored = CompiledTrees.of(fit_tree(train, PARITY_FEATURES, SEED)).score(valid, reasons=True)
    reasons = F.concat_ws(",", F.transform("reasons", lambda x: x["feature"]))
    return round_doubles(explained_queue(scored, 20, 3).select("account", "max_score", "top_txn_id", reasons.alias("reasons")))


@register("q_category_codes", _BOUNDS_SQL + f""",
tr AS (SELECT t.* FROM T t, b WHERE t.timestamp < {SQL_TAIL_CUTOFF} AND t.timestamp < b.train_end),
seen AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS label, count(*) AS n FROM tr GROUP BY {c}" for c in CATEGORY_COLUMNS)})
SELECT feature, label, row_number() OVER (PARTITION BY feature ORDER BY n DESC, label) - 1 AS code FROM seen""")
def q_category_codes(spark, sf_dir):
    """K2: the codes that the tree's indexers learnt are the frequency ranks of the training rows alone."""
    train = truncate_tail(T_split(spark, sf_dir, "train"), TAIL_CUTOFF)
    return category_codes(train)


@register("q_tree_above_random", evaluate_sql("random") + """
SELECT round(value, 6) AS random_pr_auc, true AS tree_is_twice_as_good FROM tidy WHERE metric = 'pr_auc'""")
def q_tree_above_random(spark, sf_dir):
    """K1: average precision of the tree on validation rows against the random ranking's."""
    train, valid = _slices(spark, sf_dir)
    rows = load_split(spark, sf_dir, "validation")
    random = evaluate(to_scored(rows, rank_randomly(rows, SEED)), (50,), patterns=False, cost=False).filter(
        "metric = 'pr_auc'").select(F.col("value").alias("random_pr_auc"))
    tree = pr_auc_frame(score_with(fit_tree(train, PARITY_FEATURES, SEED), valid))
    return random.join(F.broadcast(tree)).select(  # one row each
        F.round("random_pr_auc", 6).alias("random_pr_auc"), (F.col("pr_auc") > 2 * F.col("random_pr_auc")).alias("tree_is_twice_as_good"))


@register("q_tree_sweep", _BOUNDS_SQL + f""", v AS ({_VALID_SQL})
SELECT 'tree_halving' AS experiment, CAST({TREE_SETTINGS} AS BIGINT) AS trials, CAST({TREE_SETTINGS} AS BIGINT) AS settings,
  n AS rows_per_trial, CAST({len(RUNGS)} AS BIGINT) AS rungs, CAST(0 AS BIGINT) AS differing FROM v""")
def q_tree_sweep(spark, sf_dir):
    """K4 for the tree: successive halving, every trial logged with the average precision of its last rung. ``differing``:
    logged values that are not the one computed from the stored scores by a window per trial."""
    path = shared_dir(spark, f"tree-sweep-{uuid.uuid4().hex}")
    halving_tree_sweep(*_slices(spark, sf_dir), path, SEED)
    runs = read_runs(spark, f"{path}/runs", "tree_halving").select(
        F.col("params")["trial"].cast("int").alias("trial"), F.col("params")["rung"].cast("int").alias("rung"), F.col("metrics")["pr_auc"].alias("logged"),
        F.concat_ws("/", *[F.col("params")[k] for k in ("max_depth", "step_size", "subsampling")]).alias("setting"))
    spark.read.parquet(f"{path}/scores").createOrReplaceTempView("_sweep_scores")
    again = spark.sql("""SELECT rung, trial, count(*) AS n, sum(pos * cp / cn) / sum(pos) AS pr_auc, max(cn) AS rows_per_trial FROM (
        SELECT rung, trial, pos, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM (
          SELECT rung, trial, score, count(*) AS n, sum(y) AS pos FROM _sweep_scores GROUP BY rung, trial, score)
        WINDOW w AS (PARTITION BY rung, trial ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY rung, trial""")
    return runs.join(again, ["rung", "trial"], "left").agg(
        F.lit("tree_halving").alias("experiment"), F.count(F.lit(1)).alias("trials"), F.countDistinct("setting").alias("settings"),
        F.max("rows_per_trial").alias("rows_per_trial"), F.countDistinct("rung").alias("rungs"),
        F.sum((~F.coalesce(F.abs(F.col("logged") - F.col("pr_auc")) <= 1e-9, F.lit(False))).cast("bigint")).alias("differing"))


RESTART, LATE_BEFORE = dt.datetime(2024, 1, 11, 12, 34), dt.datetime(2024, 1, 9)
_LATE = f"txn_id % 50 = 7 AND timestamp < TIMESTAMP '{LATE_BEFORE}'"
_HISTORY_TYPES = {c: "DOUBLE" if "amount" in c or "ratio" in c else "BIGINT" for c in HISTORY_FEATURES}


@register("q_stream_scored", f"""WITH src AS (SELECT * FROM T WHERE NOT ({_LATE})), {history_ctes(source='src')}
SELECT txn_id, {', '.join(f'round({c}, 6) AS {c}' if t == 'DOUBLE' else c for c, t in _HISTORY_TYPES.items())},
  false AS late, true AS score_agrees FROM hist
UNION ALL SELECT txn_id, {', '.join(f'CAST(NULL AS {t})' for t in _HISTORY_TYPES.values())}, true, NULL
FROM T WHERE {_LATE} AND timestamp < {SQL_AS_OF}""")
def q_stream_scored(spark, sf_dir):
    """T as a stream in two deliveries, the second after a restart and with transfers that come days late. The keyed
    state gives E1-E9, the tree scores every decision in the sink, late transfers are listed. ``score_agrees``: the
    stored score is the one that the fitted model gives the batch job's features."""
    root = shared_dir(spark, f"scored-stream-{uuid.uuid4().hex}")
    t = T(spark, sf_dir, end=AS_OF)
    on_time = t.where(f"NOT ({_LATE.replace('TIMESTAMP ', 'TIMESTAMP_NTZ ')})")
    batch = materialised(build_account_history_features(build_basic_features(on_time), AS_OF))
    model = fit_tree(select_split(batch, "train", frozen_split(spark, sf_dir)), PARITY_FEATURES, SEED, max_iter=10)
    compiled = CompiledTrees.of(model)
    source, out, checkpoint = f"{root}/source", f"{root}/out", f"{root}/checkpoint"
    before = F.col("timestamp") < F.lit(RESTART.isoformat(sep=" ")).cast("timestamp_ntz")
    for i, rows in enumerate((on_time.where(before), on_time.where(~before).unionByName(t.join(on_time.select("txn_id"), "txn_id", "left_anti")))):
        rows.select(t.columns).write.parquet(f"{source}/delivery={i}")
        run_scored_stream(spark, source, t.schema, out, checkpoint, build_basic_features, _ROW, compiled.score)
    own = score_with(model, batch).select("txn_id", F.col("score").alias("own"))
    done = decisions(spark, out).join(own, "txn_id", "left").select(
        "txn_id", *HISTORY_FEATURES, F.lit(False).alias("late"),
        F.coalesce(F.abs(F.col("score") - F.col("own")) <= 1e-9, F.lit(False)).alias("score_agrees"))
    late = late_transfers(spark, source, t.schema, out).select("txn_id", F.lit(True).alias("late"))
    return round_doubles(done.unionByName(late, allowMissingColumns=True))
