import random

import pytest
from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.history import build_account_history_features
from ringwatch.operators.models import (PARITY_FEATURES, class_balance, feature_importance, fit_tree, score_with,
                                        sweep)
from ringwatch.operators.scaler import EdgeScaler
from ringwatch.sources.tracking import log_metrics_frame, read_runs


def _frame(make_transfers, n=300):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        pos = rng.random() < 0.15
        rows.append(transfer(i, ts(rng.randrange(0, 200)), f"A{rng.randrange(12)}", f"A{rng.randrange(12)}",
                             amount=round(rng.uniform(500, 900) if pos else rng.uniform(1, 400), 2), label=int(pos)))
    return build_account_history_features(build_basic_features(make_transfers(rows)), None)


def test_class_balance(make_transfers):
    r = class_balance(_frame(make_transfers)).first()
    assert r.pos_weight == pytest.approx(r.n_negative / r.n_positive)


def test_scaler_train_only_moments(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (3.0, 5.0, 1.0)], "a double, b double, c double")
    sc = EdgeScaler.fit(df, ["a", "b", "c"])
    import math
    vals = [math.log1p(x) for x in (1.0, 2.0, 3.0)]
    assert sc.mean["a"] == pytest.approx(sum(vals) / 3)
    assert sc.std["b"] == 1.0  # constant column
    out = sc.transform(df, ["a", "b", "c"]).collect()
    assert all(math.isfinite(r[c]) for r in out for c in "abc")


def test_tree_learns_and_sweep_logs(spark, make_transfers, tmp_path):
    f = _frame(make_transfers)
    train, valid = f.filter(F.col("txn_id") % 3 != 0), f.filter(F.col("txn_id") % 3 == 0)
    m = fit_tree(train, PARITY_FEATURES, max_iter=5)
    s = score_with(m, valid)
    assert s.count() == valid.count()
    imp = {r.feature: r.importance for r in feature_importance(m, PARITY_FEATURES).collect()}
    assert imp["log_amount"] == max(imp.values())  # amounts separate the classes here
    trials = sweep(train, valid, n_trials=1, log_path=str(tmp_path / "runs"))
    assert len(trials) == 1 and 0 < trials[0]["pr_auc"] <= 1
    assert read_runs(spark, str(tmp_path / "runs"), "tree_sweep").count() == 1


def test_log_metrics_frame(spark, tmp_path):
    flat = spark.createDataFrame([("pr_auc", 0.5), ("n_rows", 10.0)], "name string, value double")
    log_metrics_frame(flat, str(tmp_path / "runs"), "baselines", {"model": "amount"}, {"phase": "2"})
    r = read_runs(spark, str(tmp_path / "runs"), "baselines").first()
    assert r.metrics == {"pr_auc": 0.5, "n_rows": 10.0} and r.params == {"model": "amount"}


def test_trials_are_checked_in_one_table(spark):
    """Each trial scores each row once; a row scored twice by one trial and never by another is found, over more trials than bits."""
    from ringwatch.operators.models import check_trials

    rows = spark.createDataFrame([(1,), (2,), (3,)], "txn_id bigint")
    for n in (2, 62, 130):
        good = [(t, i) for t in range(n) for i in (1, 2, 3)]
        check_trials(spark.createDataFrame(good, "trial int, txn_id bigint"), rows, n)
        for bad in (good[:-1], good + [(0, 9)], [x for x in good if x != (n - 1, 2)] + [(0, 2)], good + [(0, None)]):
            with pytest.raises(ValueError, match="do not match"):
                check_trials(spark.createDataFrame(bad, "trial int, txn_id bigint"), rows, n)


def test_alignment_counts_rows_scores_and_losses(spark):
    from ringwatch.operators.models import check_alignment

    rows = spark.createDataFrame([(1,), (2,), (3,)], "txn_id bigint")
    check_alignment(spark.createDataFrame([(3,), (2,), (1,)], "txn_id bigint"), rows)
    for ids, text in (([1, 2], "3 rows, 2 scores, 2 of different rows, 1 rows"), ([1, 2, 2], "3 rows, 3 scores, 2 of different rows, 1 rows"),
                      ([1, 2, 4], "3 rows, 3 scores, 3 of different rows, 1 rows")):
        with pytest.raises(ValueError, match=text):
            check_alignment(spark.createDataFrame([(i,) for i in ids], "txn_id bigint"), rows)


def test_sweep_checks_and_ranks_all_trials_together(spark, make_transfers, tmp_path, monkeypatch):
    """One running sum for all trials, not one each; every value is the trial's own average precision."""
    from ringwatch.operators import metrics
    from ringwatch.operators.models import EDGE_GRID, draw_trials, fit_edge_scorer, sweep_edge_scorer

    calls, real = [], metrics.prefix_sum
    monkeypatch.setattr(metrics, "prefix_sum", lambda *a, **k: calls.append(1) or real(*a, **k))
    f = _frame(make_transfers, 150).na.fill(0, ["sender_seconds_since_last_send"])
    train, valid, cols = f.filter("txn_id % 3 != 0"), f.filter("txn_id % 3 = 0"), ["log_amount", "hour"]
    got = sweep_edge_scorer(train, valid, cols, n_trials=3, log_path=str(tmp_path / "runs"))
    assert len(calls) == 1
    for r, p in zip(got, draw_trials(EDGE_GRID, 3)):
        assert r["pr_auc"] == pytest.approx(metrics.pr_auc(score_with(fit_edge_scorer(train, cols, **p), valid)), abs=1e-12)
    assert {int(r.params["trial"]): r.metrics["pr_auc"] for r in read_runs(spark, str(tmp_path / "runs")).collect()} == {
        r["trial"]: r["pr_auc"] for r in got}


def test_shared_passes_fit_what_single_fits_do(spark, monkeypatch):
    """Coefficients of every setting equal MLlib's own, drawn over uneven columns, a constant one and blocks of a few rows."""
    from ringwatch.operators import linear_fits
    from ringwatch.operators.compiled import CompiledLinear
    from ringwatch.operators.models import fit_edge_scorer

    monkeypatch.setattr(linear_fits, "BLOCK_ROWS", 37)
    rng = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = rng.gauss(3, 2), rng.expovariate(0.01), rng.random()
        rows.append((i, a, b, c, 7.0, int(a / 2 + b / 100 + rng.gauss(0, 1) > 3.5)))
    df = spark.createDataFrame(rows, "txn_id bigint, a double, b double, c double, k double, is_laundering int").repartition(3)
    cols = ["a", "b", "c", "k"]
    settings = [{"reg_param": r, "elastic_net": e, "weight_power": w} for r, e, w in ((0.001, 0.0, 1.0), (0.1, 0.5, 0.5), (0.03, 1.0, 0.0), (0.01, 0.5, 1.0))]
    for s, got in zip(settings, linear_fits.fit_linear(df, cols, settings)):
        own = CompiledLinear.of(fit_edge_scorer(df, cols, **s))
        assert got.coefficients == pytest.approx(own.coefficients, rel=2e-3, abs=2e-4) and got.coefficients[3] == 0
        assert got.intercept == pytest.approx(own.intercept, rel=2e-3, abs=2e-3)


def test_shared_fits_of_one_class_and_bad_rows(spark):
    from ringwatch.operators.linear_fits import fit_linear, score_linear

    df = spark.createDataFrame([(1, 0.5, 0), (2, 1.5, 0)], "txn_id bigint, a double, is_laundering int")
    s = [{"reg_param": 0.1, "elastic_net": 0.0, "weight_power": 1.0}] * 2
    assert {(r.trial, r.txn_id, r.y, r.score) for r in score_linear(fit_linear(df, ["a"], s), df).collect()} == {
        (t, i, 0, 0.0) for t in (0, 1) for i in (1, 2)}
    with pytest.raises(ValueError, match="no training rows"):
        fit_linear(df.limit(0), ["a"], s)
    with pytest.raises(ValueError, match="not finite"):
        fit_linear(spark.createDataFrame([(1, None, 0), (2, 1.5, 1)], df.schema), ["a"], s)


def test_sweep_passes_over_the_rows_do_not_grow_with_trials(spark, make_transfers, monkeypatch):
    from ringwatch.operators import linear_fits
    from ringwatch.operators.models import sweep_edge_scorer

    calls, real = [], linear_fits.summed
    monkeypatch.setattr(linear_fits, "summed", lambda *a: calls.append(1) or real(*a))
    f = _frame(make_transfers, 150).na.fill(0, ["sender_seconds_since_last_send"])
    got = sweep_edge_scorer(f.filter("txn_id % 3 != 0"), f.filter("txn_id % 3 = 0"), ["log_amount", "hour"])
    assert len(got) == 20 and len(calls) < 20


def test_edge_scorer_scores_in_an_observed_session(spark):
    from pyspark.sql import Observation

    from ringwatch.operators.models import fit_edge_scorer

    seen = Observation("rows")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    df = spark.createDataFrame([(i, i % 7 + 0.5 * (i % 2), 1.0, i % 2) for i in range(40)], "txn_id bigint, a double, amount_paid double, is_laundering int")
    scored = score_with(fit_edge_scorer(df, ["a"]), df)
    assert scored.agg(F.max("score"), F.sum("y")).first()[1] == 20
